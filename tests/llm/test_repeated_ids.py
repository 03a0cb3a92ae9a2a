"""Documents that share an id but differ in text are told apart."""

from pyspark.sql import functions as F

import corpus_pipeline
from wagerlens.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(name, n=60):
    return " ".join(f"{name}{k}" for k in range(n))


def edited(text, k=30):
    words = text.split()
    words[k] = "edited"
    return " ".join(words)


ROWS = [
    (1, prose("a")),
    (5, prose("a")),  # a copy of 1
    (5, prose("b")),  # like no other
    (5, prose("c")),
    (5, prose("c")),  # repeats the row before
    (7, prose("z")),
    (7, prose("d")),
    (9, edited(prose("z"))),  # near the larger text of 7
    (9, prose("e")),
    (11, prose("f")),
    (11, edited(prose("f"))),  # near a text of its own id
    (12, edited(prose("f"), 5)),
    (None, prose("a")),
]


def test_nodes_are_ids_with_texts(spark):
    df = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in ROWS], SCHEMA)
    got = near_duplicates(df, size=5, hash_col="h").join(df.select("text", F.xxhash64("text").alias("h")).distinct(), "h")
    component = {(r.doc_id, r.text): (r.component_id, r.kept) for r in got.collect()}
    assert component[5, prose("a")] == (1, False) and component[1, prose("a")] == (1, True)
    assert component[5, prose("b")] == component[5, prose("c")] == (5, True)
    assert component[7, prose("z")] == component[7, prose("d")] == (7, True)
    assert component[9, edited(prose("z"))] == (7, False) and component[9, prose("e")] == (9, True)
    assert {component[i, t][0] for i, t in ROWS if i in (11, 12)} == {11}
    assert sorted(component[i, t][1] for i, t in ROWS if i in (11, 12)) == [False, False, True]
    assert component[None, prose("a")] == (None, True)
    assert len(got.collect()) == len(ROWS)


def test_pipeline_stage_cuts_no_text(spark):
    df = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in ROWS], SCHEMA)
    left = corpus_pipeline.near_duplicates(spark, df, "")
    assert left.columns == list(corpus_pipeline.COLUMNS)
    got = [(r.doc_id, r.text) for r in left.collect()]
    want = {(i, t) for i, t in ROWS if i not in (11, 12)} - {(5, prose("a")), (9, edited(prose("z")))}
    assert {x for x in got if x[0] not in (11, 12)} == want and len([x for x in got if x[0] not in (11, 12)]) == len(want)
    assert [i for i, _ in got if i in (11, 12)] == [11]
