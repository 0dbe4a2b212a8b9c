"""DuckDB SQL oracle for the registered queries."""
