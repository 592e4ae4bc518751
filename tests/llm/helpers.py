"""Small documents with every awkward case: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

PLAIN = (
    "The river runs past the old mill and the people of the village walk along its bank every evening in summer."
)
GERMAN = "Der Fluss fließt an der alten Mühle vorbei und die Leute aus dem Dorf gehen jeden Abend am Ufer spazieren."

DOCUMENTS = [
    (1, PLAIN, "en", "a"), (2, PLAIN, "en", "a"), (2, PLAIN, "en", "a"), (3, None, "en", "b"), (4, "", None, "b"),
    (5, " \t\n ", "de", None), (6, "12 34 !!", "de", None), (7, GERMAN, "de", "c"), (None, PLAIN, None, None),
    (8, (PLAIN + " ") * 400, "en", "a"), (9, GERMAN.upper(), None, "c"), (10, "word", "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=None, extra: bool = True):
    df = spark.createDataFrame(DOCUMENTS if rows is None else rows, SCHEMA)
    if extra:  # names that the operators use for their own columns
        df = df.selectExpr(
            "*", "'x' as score", "'x' as n_tokens", "1 as size", "2 as block", "'y' as component_id", "0 as n_entities",
            "'z' as kinds", "'q' as held_out", "3 as rep", "'h' as host",
        )
    return df


def with_texts(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], SCHEMA)
