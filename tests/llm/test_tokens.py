"""Byte-level BPE, token-id files and packing against the public libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm import bpe, idfile, packing, scratch
from postlake.llm.pretokens import split_block
from postlake.llm.token_ids import library_encoder
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "s", "t", "re", "ll", "'", "'s", "'re", "the", "ion", " ", "  ", "\n", "\t", "1", "é", "ß", "漢", "!", "-",
          " ", "\x1c", "😀", "́"]


def _texts(n=1500, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [
        "", " ", "\n\n", "a" * 3000, "abab" * 900 + "!" * 700, "<|endoftext|> x"]


def _library():
    out = Tokenizer.from_file(VOCABULARY)
    out.encode_special_tokens = True
    return out


def test_pre_tokens_equal_the_pattern():
    texts, pattern = _texts(), regex.compile(public_tokenizers.PATTERN)
    block = split_block(pa.array(texts))
    words = [w.decode() for w in block.words.to_pylist()]
    for i, text in enumerate(texts):
        assert [words[j] for j in block.index[block.bounds[i]:block.bounds[i + 1]]] == pattern.findall(text)


def test_matrix_bpe_equals_tiktoken_and_decodes_back():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts, encoder = _texts(seed=2), bpe.MatrixBpe(RANKS)
    ids, bounds = encoder.encode_texts(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want.encode_ordinary(text)
    data, ends = encoder.decode(ids, bounds)
    assert [data[ends[i]:ends[i + 1]].tobytes().decode() for i in range(len(texts))] == texts
    with pytest.raises(ValueError):
        encoder.decode(np.array([60_000]), np.array([0, 1]))


def test_a_forgetful_cache_gives_the_same_ids():
    small = bpe.MatrixBpe(RANKS, max_cached=3)
    texts = _texts(200, seed=3)
    want = bpe.matrix_bpe(RANKS).encode_texts(pa.array(texts))[0]
    got = np.concatenate([small.encode_texts(pa.array(texts[i:i + 20]))[0] for i in range(0, len(texts), 20)])
    assert (got == want).all()


def test_library_ids_equal_the_library():
    texts = _texts(600, seed=4)
    ids, bounds = library_encoder(VOCABULARY).encode_texts(pa.array(texts))
    for i, e in enumerate(_library().encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == e.ids


def _odd(spark):
    """Nulls, empty texts, repeated rows and ids, and columns with clashing names."""
    rows = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "no id"), (5, "x" * 5000), (5, "other")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"ids": F.lit("z"), "piece": F.lit(1), "start": F.lit(None).cast("int"), "n_tokens": F.lit(1)})


def test_bpe_operator_on_odd_rows_and_an_empty_table(spark):
    out = bpe.decode(bpe.encode(_odd(spark), RANKS), RANKS).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in out) == sorted(
        [("1", "one two"), ("1", "one two"), ("2", ""), ("3", ""), ("None", "no id"), ("5", "x" * 5000), ("5", "other")])
    assert bpe.encode(_odd(spark).limit(0), RANKS).count() == 0


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000, 1001])
def test_image_round_trip_and_partial_reads(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    image = idfile.pack_image(ids, planes, block_ids=64)
    assert (idfile.unpack_image(image) == ids).all()
    for first, last in ((0, 1), (63, 65), (n // 2, n), (n, n + 5)):
        assert (idfile.unpack_image(image, first, last) == ids[first:last]).all()
    with pytest.raises(ValueError):
        idfile.unpack_image(b"xxxx" + image[4:])


@pytest.mark.parametrize("planes", [4, 32])
def test_id_files_hold_all_ids_in_document_order(spark, planes):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = scratch.new_path(spark, "ids")
    idfile.write_ids(docs, path, VOCABULARY, planes=planes, block_ids=500, shard_ids=4000)
    got = sorted(idfile.read_ids(spark, path).collect(), key=lambda r: r.doc_id)
    start, lib = 0, _library()
    for r, d in zip(got, sorted(docs.collect(), key=lambda r: r.doc_id), strict=True):
        ids = lib.encode(d.text, add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)


def test_id_files_of_odd_rows_and_an_empty_table(spark):
    path = scratch.new_path(spark, "odd")
    idfile.write_ids(_odd(spark), path, VOCABULARY)
    out = sorted(idfile.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, 1, 1, 2, 3, 5, 5]
    assert [r.start for r in out] == [sum(r.n_tokens for r in out[:i]) for i in range(len(out))]
    assert [r.n_tokens for r in out if r.doc_id in (2, 3)] == [1, 1]
    empty = scratch.new_path(spark, "empty")
    idfile.write_ids(_odd(spark).limit(0), empty, VOCABULARY)
    assert idfile.read_ids(spark, empty).count() == 0


# --- packing ------------------------------------------------------------------

def _bfd(items, capacity):
    bins = []
    for x in sorted(items, reverse=True):
        fits = [b for b in bins if capacity - b >= x]
        if fits:
            bins.remove(max(fits))
            bins.append(max(fits) + x)
        else:
            bins.append(x)
    return len(bins)


def _fewest(items, capacity):
    items, best = sorted(items, reverse=True), [_bfd(items, capacity)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                place(i + 1, [b + items[i] * (j == k) for j, b in enumerate(bins)])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum_and_best_fit_equals_one_by_one():
    rnd, fixed_any = random.Random(5), 0
    for _ in range(250):
        capacity = rnd.choice([10, 17, 20, 30])
        items = [rnd.randint(rnd.choice([1, 3, capacity // 4]), capacity) for _ in range(rnd.randint(1, 10))]
        counts = np.bincount(items, minlength=capacity + 1)
        assert sum(n for n, _ in packing.best_fit(counts, capacity)) == _bfd(items, capacity)
        fixed, left = packing.reduce_instance(counts, capacity)
        assert all(sum(x * c for x, c in content) <= capacity for _, content in fixed)
        rest = [x for x in range(capacity + 1) for _ in range(left[x])]
        n_fixed = sum(n for n, _ in fixed)
        fixed_any += n_fixed
        assert n_fixed + (_fewest(rest, capacity) if rest else 0) == _fewest(items, capacity)
        packing.make_plan(counts, capacity)
    assert fixed_any > 100


def _check_packing(rows, texts, capacity):
    lib, by_sequence = _library(), {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        cut = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in cut] == list(range(len(cut)))
        assert [r.start for r in cut] == [sum(x.length for x in cut[:i]) for i in range(len(cut))]
        assert sum(r.length for r in cut) == len(ids) and all(r.length == capacity for r in cut[1:])
        for r in cut:
            data = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(data) == r.ids_crc32 and bytes(r.ids) == data
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_pack_places_every_piece_of_every_document(spark, capacity):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    rows = packing.pack(docs, VOCABULARY, capacity=capacity, with_ids=True).collect()
    used = _check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, capacity)
    assert used <= 1.05 * -(-sum(r.length for r in rows) // capacity) + 1


def test_pack_odd_rows_and_an_empty_table(spark):
    rows = packing.pack(_odd(spark), VOCABULARY, capacity=16).collect()
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == ["1", "1", "2", "3", "5", "5", "None"]
    assert packing.pack(_odd(spark).limit(0), VOCABULARY).count() == 0


# --- added tokens of the vocabulary file ---------------------------------------

END = "<|endoftext|>"


def test_added_tokens_inside_texts_equal_the_library():
    library = Tokenizer.from_file(VOCABULARY)
    texts = [f"a {END} x", END, END * 3, f"{END}  two  {END}\n", "plain text", "", None, f"don{END}'t <|endoftext| > é{END}",
             *(t.replace("!", END) for t in _texts(300, seed=6))]
    ids, bounds = library_encoder(VOCABULARY, added_tokens=True).encode_texts(pa.array(texts))
    assert len(bounds) == len(texts) + 1 and ids.dtype == np.int32
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert ids[:bounds[1]].tolist() == [64, 220, 50256, 2124]


def test_operators_keep_added_tokens_whole(spark):
    library = Tokenizer.from_file(VOCABULARY)
    texts = {1: f"a {END} x", 2: "plain", 3: f"{END}{END} " * 30, 4: "after"}
    want = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    path = scratch.new_path(spark, "added")
    idfile.write_ids(docs, path, VOCABULARY)
    out = {r.doc_id: r for r in idfile.read_ids(spark, path).collect()}
    assert {i: np.frombuffer(r.ids, "<u4").tolist() for i, r in out.items()} == want
    assert [out[i].start for i in (1, 2, 3, 4)] == [sum(len(want[j]) for j in range(1, i)) for i in (1, 2, 3, 4)]
    pieces = packing.pack(docs, VOCABULARY, capacity=16, with_ids=True).collect()
    for i, ids in want.items():
        cut = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.piece)
        assert [x for r in cut for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
