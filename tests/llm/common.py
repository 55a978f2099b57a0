"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

LONG = "palabra uno dos tres " * 40_000
ODD = [
    (1, None, "en"), (2, "", "en"), (3, "   \n", None), (4, "hello world this is a plain sentence of words", "en"), (4, "hello world this is a plain sentence of words", "en"),
    (5, LONG, "es"), (None, "text without any id but with words in it", "en"), (None, None, None), (6, "!!! ### 12", "de"), (7, "日本語のテキスト", None), (8, "x", "es"),
]
#: Names that operators use inside.
CLASH = ["rep", "ids", "comp", "grams", "bands", "term", "row", "score", "kind", "label", "votes", "hash", "blocks", "new_shard", "old_shard", "__hit", "moved", "n", "u", "v", "winner", "path", "rank", "part", "buckets", "y", "label_id"]


def odd(spark, rows=ODD):
    """(doc_id, text, lang, source, n_chars) and columns whose names clash."""
    full = [(i, t, g, None if i is None else f"s{i % 3}", None if t is None else len(t), *["c"] * len(CLASH)) for i, t, g in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))
