import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shutterlake.llm import chat, queries
from tests.llm.support import FOLDER, needs_tables, prose

TEXTS = [
    None, "", "plain", "\\### Assistant: </turn> ok", "### x", "### ", "</turn>", "\n</turn>\n",
    "a\\", "\\", "\\\\</turn>\\", "#### y ### ### </turn></turn>", "ends ###", ": colon", "x: y",
    "\n", "é🙂</turn>é", "\\\\\\### \\</turn", "</tur\n", prose(3, 20_000), "\\" * 50_000,
    "### " * 5_000,
]
ROLES = ["user", "assistant", None, "", "a: b", "### r", "x</turn>", "tool\n", "\\h\\", ":", "r:"]


def cases():
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TEXTS)]
    rows += [(2, i, r, t) for i, r in enumerate(ROLES) for t in (": </turn>", "x")]
    rows += [(None, None, "user", "null id"), (None, 1, "assistant", "a"), (None, 1, "assistant", "a")]
    return rows


def frame(spark, rows):
    data = [(*r, "x", True) for r in rows]
    kinds = "conv_id bigint, turn bigint, role string, text string, Formatted string, segments boolean"
    return spark.createDataFrame(data, kinds)


def expected(rows):
    out = {}
    order = sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    for c, _, role, text in order:
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_turns_are_read_back_from_the_output(spark):
    rows = cases()
    found = chat.format_conversations(frame(spark, rows).repartition(5))
    found = found.withColumn("turns", chat.parse(F.col("formatted")))
    found = found.withColumn("learned", chat.learned_text(F.col("segments"))).collect()
    want = expected(rows)
    assert {r["conv_id"] for r in found} == set(want)
    for row in found:
        own = want[row["conv_id"]]
        assert row["n_turns"] == len(own)
        assert [tuple(t) for t in row["turns"]] == own
        assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
        assert row["learned"] == "".join(t for role, t in own if role == "assistant")
    assert chat.format_conversations(frame(spark, rows[:0])).count() == 0


def test_only_conflicts_are_escaped(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(["a\\b", "### x", "\\</turn>", "C# ###"])]
    found = chat.format_conversations(frame(spark, rows)).orderBy("conv_id").collect()
    assert [r["formatted"] for r in found] == [
        "### user: a\\b\n</turn>\n", "### user: \\### x\n</turn>\n",
        "### user: \\\\</turn>\n</turn>\n", "### user: C# ###\n</turn>\n",
    ]


def test_parser_finds_no_turn_where_the_text_is_broken(spark):
    texts = ["", "x", "### user: a\n</turn>\n### user", "### user: a\n</turn>\n</turn>\n", "### a\n</turn>\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [[tuple(t) for t in r[0]] for r in rows.select(chat.parse(F.col("t"))).collect()]
    none = (None, None)
    assert found == [[], [none], [("user", "a"), none], [none], [none]]


def test_plan_has_no_python(spark):
    rows = frame(spark, cases())
    plan = queries.formatted(rows.select("conv_id", "turn", "role", "text"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


@needs_tables
@pytest.mark.parametrize("name", ["op12_chat"])
def test_query(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    with duckdb.connect() as db:
        db.sql(f"create view conversations as from '{FOLDER}/conversations.parquet'")
        want = db.sql(queries.ORACLE[name])
        columns = sorted(want.columns)
        rows = want.project(", ".join(columns)).fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, rows))
    special = found.where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert special["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    turns = f"user\n{text}\nassistant\n{text}\n"
    assert special["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
