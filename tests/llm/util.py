"""Helpers of these tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    """rows: (doc_id, text[, lang[, source]]) over two partitions."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(2)


def find(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i
