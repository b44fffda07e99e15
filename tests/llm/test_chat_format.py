import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.llm import chat_format, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _format(spark, rows):
    return {r["conv_id"]: r for r in chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_plain_turns_are_not_escaped(spark):
    got = _format(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "there")])[1]
    assert got["formatted"] == "<s>[INST] user [/INST]hi</s><s>[INST] assistant [/INST]there</s>"
    assert got["level"] == 0 and got["round_trip"]
    assert [(t["role"], t["text"]) for t in got["parsed"]] == [("user", "hi"), ("assistant", "there")]


pieces = st.sampled_from(["</s>", "<s>", "[INST]", " [/INST]", "[/INST]", "\\", "\\\\", "<", "/s>", "a", "é", "\n", "</", "[", "INST]", "$1", "𝔘"])
contents = st.lists(pieces, max_size=7).map("".join)
turns = st.lists(st.tuples(contents, contents), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(turns, min_size=20, max_size=40))
def test_any_content_comes_back(spark, conversations):
    rows = [(c, t, role, text) for c, made in enumerate(conversations) for t, (role, text) in enumerate(made)]
    got = _format(spark, rows)
    for c, made in enumerate(conversations):
        assert [(t["role"], t["text"]) for t in got[c]["parsed"]] == made
        assert got[c]["round_trip"]


def test_loss_spans_cover_the_assistants_texts(spark):
    rows = [(1, 0, "user", "é?"), (1, 1, "assistant", "𝔘 </s>"), (1, 2, "assistant", ""), (1, 3, "user", "x"), (1, 4, "assistant", "end")]
    got = _format(spark, rows)[1]
    shown = [got["formatted"][s["start"] : s["end"]] for s in got["loss_spans"]]
    assert [s.replace("<\\", "<") for s in shown] == ["𝔘 </s>", "", "end"]


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", "first"), (1, 0, "b", None), (1, 0, "a", "x"), (1, 0, "a", "x"), (None, 0, None, "t"), (None, 1, "u", None)]
    got = _format(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["parsed"]] == [("user", "first"), ("a", "x"), ("a", "x"), ("b", "")]
    assert [(t["role"], t["text"]) for t in got[None]["parsed"]] == [("", "t"), ("u", "")]
    assert all(r["round_trip"] for r in got.values())


def test_empty_table_and_long_text(spark):
    assert _format(spark, []) == {}
    long = "</s>\\word " * 20_000
    got = _format(spark, [(1, 0, "assistant", long)])[1]
    assert got["round_trip"] and got["parsed"][0]["text"] == long


def test_text_outside_the_grammar_is_no_turn(spark):
    parsed = spark.range(1).select(chat_format.parse(F.lit("no marks</s>")).alias("p")).first()["p"]
    assert parsed[0]["text"] is None


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    source = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        source.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    source[-1] = [(0, "user", queries.PLANTED), (1, "assistant", queries.PLANTED)]
    got = {r["conv_id"]: r for r in queries.op1_chat_format(spark, sf).collect()}
    assert set(got) == set(source)
    for conv, rows in source.items():
        rows.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(rows), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["round_trip"]
