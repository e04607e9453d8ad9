from marlstone.llm.jaccard_join import keep_one

from .helpers import clashing, documents


def test_a_copy_takes_only_its_own_row_along(spark):
    copy, clean = "a b c d e f g h", "quite another text with words of its own"
    rows = [(1, copy), (5, copy), (5, clean), (5, None), (6, clean), (7, copy), (None, copy), (None, "some words under no id at all"), (None, None)]
    df = clashing(documents(spark, rows))
    kept = keep_one(df)
    assert kept.columns == df.columns
    want = [(1, copy), (5, clean), (5, None), (None, "some words under no id at all"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
