"""Queries of the folder that SQL can express, against DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from meterline.llm.queries import QUERIES, SQL

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from '{D}/{table}.parquet'")
    df = QUERIES[name](spark, D)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())


def test_quotes_same_as_sql(spark):
    """Threads that quote whole messages, parts of them, single lines and unknown ones, at several levels."""
    import random

    from meterline.llm import quotes

    r = random.Random(8)
    common = ["ok", "Thanks!", "see below", "I agree."]
    rows = []
    for conv in range(25):
        said = []
        for turn in range(r.choice([1, 2, 8, 40])):
            text = []
            for _ in range(r.choice([0, 1, 1, 2])):
                if said:
                    old = r.choice(said)
                    a = r.randrange(len(old) + 1)
                    text += [">" + " " * r.randint(0, 1) + x for x in (old if r.random() < 0.5 else old[a : a + r.randint(0, 4)])]
                if r.random() < 0.2:
                    text.append(r.choice(["> never said", ">>", ">>> ok", "> > Thanks", ">"]))
                text.append(r.choice(common + ["", "--"]))
            text += [r.choice(common) if r.random() < 0.4 else f"Line {r.randrange(60)}, é {conv}" for _ in range(r.randint(0, 5))]
            said.append(text)
            rows.append((conv if conv else 10**6, turn * r.choice([1, 1, 3]) + turn * 900, "u", r.choice(["\n", "\r\n"]).join(text) if text else None))
    rows += [(500, 1, "u", "x y\n" * 3000), (500, 2, "a", "> x y\n" * 2000 + "z"), (501, 0, "u", "hot"), *((501, k, "u", "> hot\nhot") for k in range(1, 300))]
    seen = set()
    rows = [x for x in rows if (x[0], x[1]) not in seen and not seen.add((x[0], x[1]))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.execute(SQL["op7_quote_linking"])
    names = [c[0] for c in want.description]
    got = quotes.link_quotes(df.repartition(5)).select(*names).collect()
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted((tuple(x) for x in got), key=order) == sorted(want.fetchall(), key=order)
    assert sum(x["parent_turn"] is not None for x in got) > 100


def test_runs_are_made_where_passages_begin(spark):
    """One message of many lines, and passages of it of many lengths: few runs, and all of them linked."""
    from meterline.llm import quotes

    lines = [f"line {i} of the report {i * i}" for i in range(4000)]
    rows = [(1, 0, "u", "\n".join(lines))] + [(1, k, "a", "\n".join("> " + x for x in lines[7 * k : 8 * k + 2]) + f"\nanswer {k}") for k in range(1, 401)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    known = quotes.parsed(df)
    quoted = known.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    assert quotes.wrote_runs(known, quoted).count() <= 2 * 400
    got = quotes.link_quotes(df.repartition(4)).collect()
    assert {x["turn"]: (x["parent_turn"], x["n_quoted"]) for x in got} == {0: (None, 0)} | {k: (0, k + 2) for k in range(1, 401)}


def test_quotes_from_documents_same_as_sql(spark):
    """Threads over the lines of real texts: a turn for each document of a source, which quotes the one before it in part and
    one further back at the second level."""
    from meterline.llm import quotes

    texts = spark.read.parquet(f"{D}/documents.parquet").where("text is not null and length(text) < 4000").select("source", "doc_id", "text").orderBy("source", "doc_id").collect()
    by = {}
    for r in texts:
        by.setdefault(r["source"], []).append(r["text"].split("\n"))
    rows = []
    for conv, own in enumerate(by.values()):
        for turn, text in enumerate(own):
            quoted = [">" + x for x in own[turn - 1][turn % 3 :]] if turn else []
            quoted += [">> " + x for x in own[turn // 2][:2]] if turn % 4 == 3 else []
            rows.append((conv, turn, "u", "\n".join(quoted + text)))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.execute(SQL["op7_quote_linking"])
    names = [c[0] for c in want.description]
    got = [tuple(x) for x in quotes.link_quotes(df.repartition(5)).select(*names).collect()]
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted(got, key=order) == sorted(want.fetchall(), key=order)
    assert sum(x[names.index("parent_turn")] is not None for x in got) > 0.8 * (len(rows) - len(by))
