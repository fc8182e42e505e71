"""Small documents tables with the hard cases."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s0")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def saved(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, "one two three four"), (6, "one two three four"),
    (7, "The QUICK brown fox jumps over the lazy dog again and again " * 3), (8, "the quick brown fox jumps over the lazy dog again and again " * 3),
    (9, "é à ü ñ straße élan garçon " * 400), (None, "no id here but words"), (10, "x" * 5000), (11, "a b c d e f g h i j k l m n o p"),
]


def thue_morse(n: int = 1024) -> list[str]:
    """Two different words that polynomial hashes modulo 2^64 cannot tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
