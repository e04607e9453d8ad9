"""Small document tables with the cases that every operator has to bear."""

import glob

import pyarrow.parquet as pq

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def documents(spark, texts, first=0):
    """A table of documents; texts may be (doc_id, text) pairs."""
    rows = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (first + i, t)
        rows.append((doc, text, "en", "src0", None if text is None else len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def edge_texts():
    """Nulls, empty texts, white space, repeated rows, ties and odd characters."""
    long = "the quick brown fox jumps over the lazy dog " * 400
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "One two three four five six seven. Eight nine ten eleven twelve!"),
        (4, "One two three four five six seven. Eight nine ten eleven twelve!"),
        (5, "One two three four five six seven. Eight nine ten eleven twelve!"),
        (6, long),
        (7, "Zürich naïve café ǰ J̌ İstanbul ΣΑΣ  non break em dash—x ＜ 日本語 text 😀 <|endoftext|> <|STARTOFTEXT|>"),
        (None, None),
        (None, "a row whose id is null"),
        (8, "don't they'll  we've \x1c sep\x85 x\x0b\x0cy 3.14 a.b.c ... ,, end."),
        (9, "x" * 5000),
    ]


def clashing(df):
    """df with extra columns whose names operators may use inside."""
    from pyspark.sql import functions as F

    extra = ["shard", "part", "key", "chunk", "bucket", "words", "ids", "token", "size", "slot", "n", "id", "hash", "pos", "component_id", "length", "start", "score"]
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in extra])


def real_texts(limit=None, sf=SF):
    rows = []
    for p in sorted(glob.glob(f"{sf}/documents.parquet/*.parquet") or [f"{sf}/documents.parquet"]):
        t = pq.read_table(p, columns=["doc_id", "text"])
        rows += list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    return rows[:limit]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
