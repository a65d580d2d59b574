from __future__ import annotations


def documents(spark, rows):
    """Documents from (doc_id, text) pairs, with extra columns of names that operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, n long, name string, pos int"
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), 7, 7, "x", 7) for i, t in rows], schema)
