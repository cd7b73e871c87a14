"""Small tables with the cases that every operator must stand."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, fp string, row_id long, digest string, h int"


def documents(spark, texts, ids=None):
    """Documents with further columns whose names operators use themselves."""
    rows = [(k if ids is None else ids[k], t, "en", "src1", None if t is None else len(t), "x", -1, "y", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])
