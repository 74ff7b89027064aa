"""Queries give the rows of their SQL on rows that the test tables don't hold."""

import duckdb

from tallyloom import catalogue


def both(spark, tmp_path, name, **tables):
    """Rows by Spark and by the SQL in DuckDB, sorted."""
    db = duckdb.connect()
    for table, (rows, columns) in tables.items():
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = catalogue.QUERIES[name](spark, str(tmp_path))
    want = db.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in want.description]
    order = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    return order(got.select(*columns).collect()), order(want.fetchall())


def test_bm25_scores_that_are_equal_as_given_go_by_doc_id(spark, tmp_path):
    # the later a document, the shorter: it scores higher by less than what rounding keeps
    near = [(i, "the ing " * 20_000 + "word " * (25 - i)) for i in range(25)]
    rows = [*near, (None, "the ing " * 20_000), *[(100 + i, "some other words") for i in range(200)], (500, None), (501, "")]
    got, want = both(spark, tmp_path, "bm25_topk", documents=(rows, "doc_id long, text string"))
    assert len(want) == 20 and got == want


def test_references_over_several_answers_and_repeated_turns(spark, tmp_path):
    rows = [
        (1, 0, "user", "red.\nblue sky"), (1, 1, "assistant", "It is RED."), (1, 3, "assistant", "Blue it is"), (1, 2, "user", "is\nred. no"),
        (2, 0, "user", "a\nb\nc yes"), (2, 1, "assistant", "xa"), (2, 2, "assistant", "b"), (2, 3, "assistant", "cx"), (2, 4, "user", "b\na no"),
        (3, 0, "user", "\nx at the start"), (3, 1, "assistant", "x"), (3, 2, "assistant", "y"), (3, 3, "user", "\ny at the start"), (3, 4, "user", "y\n at the end"),
        (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 1, "assistant", "once and twice"), (4, 1, "assistant", "once and twice"),
        (5, 0, "user", "p\nq"), (5, 1, "assistant", "p"), (5, 2, "assistant", None), (5, 3, "assistant", "q"), (5, 4, "user", None), (5, 5, "user", ""), (5, 6, "user", " first"),
        (6, 0, "user", "nobody answers"), (7, 0, "user", "null"), (7, 1, "assistant", None), (None, 0, "user", "no"), (None, 1, "assistant", "no"),
        (8, 0, "user", "x\ny"), (8, None, "user", "y\nz"), (8, None, "assistant", "z"), (8, 1, "system", "x"), (8, 2, "assistant", "y"), (8, None, "user", "y"),
    ]
    got, want = both(spark, tmp_path, "reference_containment", conversations=(rows, "conv_id long, turn long, role string, text string"))
    assert got == want and any(r[3] and "\n" in r[2] for r in want)
