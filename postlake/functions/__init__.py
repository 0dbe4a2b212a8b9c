"""Scalar column functions (all native expressions)."""

from postlake.functions.rules import (  # noqa: F401
    bin_num_comments,
    bin_score,
    bin_upvote_ratio,
    categorize_text,
    concat_text,
    flag_candidate,
    flag_candidate_parts,
    flag_edited,
    flag_game_topic,
    flag_trending,
    in_list,
    map_game_topic,
    match_keyword,
    text_length,
)
from postlake.functions.text_ai import (  # noqa: F401
    ai_custom_model,
    ai_sentiment,
    ai_topics,
    with_ai_labels,
    with_ai_labels_from_parts,
)
from postlake.functions.timefmt import (  # noqa: F401
    date_from_string,
    iso_from_unix,
    parse_ds,
    ts_from_unix,
)
