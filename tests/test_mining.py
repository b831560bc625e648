"""Conversation triggers, comment triage and usage."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathomline.functions.labels import portable
from fathomline.operators import mining, usage

NOW = dt.datetime(2026, 1, 10)


def turns(spark, rows):
    data = [(c, t, r, x, NOW) for c, t, r, x in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, ts timestamp_ntz")


def test_pattern_count():
    assert sum(len(p) for _, _, p in mining.TRIGGER_FAMILIES) == 38


@pytest.mark.parametrize(
    "text, expected",
    [
        ("No, use tabs please", ("correction", "high")),
        ("I disagree with that", ("disagreement", "medium")),
        ("to clarify, the key is x", ("clarification", "medium")),
        ("it turns out the cache was stale", ("discovery", "high")),
        ("let's proceed with plan A", ("decision", "medium")),
        ("No, it turns out fine", ("correction", "high")),
        ("it\u00a0turns out fine", ("discovery", "high")),
        ("nothing of note here", None),
    ],
)
def test_families(spark, text, expected):
    hit = spark.range(1).select(mining.trigger(F.lit(text)).alias("h")).first().h
    assert (tuple(hit) if hit else None) == expected


def test_ascii_boundaries(spark):
    pattern = portable(r"\bkey\b")
    got = spark.range(1).select(F.lit("ékey").rlike(pattern), F.lit("akey").rlike(pattern)).first()
    assert tuple(got) == (True, False)


def test_trigger_filters_and_context(spark):
    long_reply = "a" * 600
    df = turns(
        spark,
        [
            (1, 0, "user", "No, use tabs please"),
            (1, 1, "assistant", long_reply),
            (1, 2, "user", "No"),
            (1, 3, "assistant", ""),
            (1, 4, "user", "I disagree with that " + "b" * 2000),
            (1, 5, "user", "no, " + " " * 60 + "x"),
            (2, 0, "user", "let's proceed with plan A"),
        ],
    )
    newest = mining.conversation_triggers(df, newest_first=True).collect()
    assert [(r.conv_id, r.turn) for r in newest] == [(2, 0), (1, 4), (1, 0)]
    whole = {(r.conv_id, r.turn): r for r in mining.conversation_triggers(df).collect()}
    assert whole[1, 4].assistant_context == long_reply and len(whole[1, 4].user_message) > 2000
    out = {(r.conv_id, r.turn): r for r in mining.conversation_triggers(df, message_chars=1000, context_chars=500).collect()}
    assert sorted(out) == [(1, 0), (1, 4), (2, 0)]
    assert out[1, 0].assistant_context is None and out[2, 0].assistant_context is None
    assert out[1, 4].assistant_context == "a" * 500
    assert len(out[1, 4].user_message) == 1000
    assert mining.conversation_triggers(df, since=NOW + dt.timedelta(days=1)).count() == 0
    counts = {r.type: (r.triggers, r.conversations) for r in mining.trigger_counts(mining.conversation_triggers(df)).collect()}
    assert counts == {"correction": (1, 1), "decision": (1, 1), "disagreement": (1, 1)}


def test_trigger_families_from_a_table(spark):
    table = spark.createDataFrame(
        [("f", 1, "high", r"\bone\b"), ("g", 3, "low", "three"), ("f", 2, "high", "two")],
        "family string, priority int, confidence string, regex string",
    )
    assert mining.families_from(table) == [("f", "high", [r"\bone\b", "two"]), ("g", "low", ["three"])]


def test_carry_over_one_long_conversation(spark):
    """A conversation cut into many chunks carries the same values as one window."""
    rows = [(1, i, "assistant" if i % 17 == 3 else "user", f"t{i}") for i in range(400)]
    rows += [(c, 0, "user", "alone") for c in range(2, 30)]
    df = turns(spark, rows)
    value = F.when(F.col("role") == "assistant", F.col("text"))
    got = {(r.conv_id, r.turn): r.x for r in mining.carry_forward(df, "conv_id", "turn", value, "x", chunk=5).collect()}
    last = None
    for i in range(400):
        assert got[1, i] == last
        last = f"t{i}" if i % 17 == 3 else last
    assert all(got[c, 0] is None for c in range(2, 30))


def test_flatten_content(spark):
    parts = '[{"type":"text","text":"a"},{"type":"image"},{"type":"text","text":""},{"type":"text","text":"b"}]'
    df = spark.createDataFrame([(parts,), ("plain",)], "c string")
    assert [r[0] for r in df.select(mining.flatten_content(F.col("c"))).collect()] == ["a\nb", "plain"]


COMMENTS = [
    (1, None, "coderabbitai[bot]", "_🔴 Critical_ fix"),
    (2, None, "coderabbitai[bot]", "_⚠️ Potential issue_ | _🟠 Major_"),
    (3, None, "coderabbitai[bot]", "_🛠️ Refactor suggestion_ | _🟠 Major_"),
    (4, None, "coderabbitai[bot]", "_🧹 Nitpick_ and _🟡 Minor_"),
    (5, None, "alice", "please look"),
    (6, 1, "alice", "Fixed in commit abc"),
    (7, 1, "coderabbitai[bot]", "Thank you for the fix. review_comment_addressed"),
    (8, None, "coderabbitai[bot]", "Learnings used"),
    (9, None, "coderabbitai[bot]", "Learnings used _🔵 Trivial_"),
    (10, 5, "other-bot", "confirmed; fingerprinting:x"),
]


def comments(spark):
    return spark.createDataFrame(COMMENTS, "id long, in_reply_to_id long, user_login string, body string")


def test_triage(spark):
    row = mining.comment_triage(comments(spark)).first().asDict()
    assert row == {
        "total": 10, "confirmations": 1, "bot_confirmations": 1, "thank_you_replies": 1, "learnings": 1,
        "fingerprints": 1, "human_fixed": 1, "critical": 1, "high": 1, "medium": 2, "low": 2, "human": 1,
    }
    buckets = {r.id: r.priority for r in mining.with_priority(comments(spark)).collect()}
    assert buckets[4] == "medium" and buckets[1] == "critical" and buckets[6] is None


def test_unanswered(spark):
    assert sorted(r.id for r in mining.unanswered(comments(spark)).collect()) == [2, 3, 4, 8, 9]
    assert tuple(mining.review_gate(comments(spark)).first()) == (5, True)
    assert tuple(mining.review_gate(comments(spark).where("id in (1, 6)")).first()) == (0, False)


def test_author_families(spark):
    logins = ["CodeRabbitAI[bot]", "cursor-bugbot[bot]", "greptile-bot", "github-actions[bot]", "x[bot]", "my-bot", "alice", None]
    df = spark.createDataFrame([(x,) for x in logins], "u string")
    got = [r[0] for r in df.select(mining.author_family(F.col("u"))).collect()]
    assert got == ["coderabbit", "bugbot", "greptile", "copilot", "unknown", "unknown", "human", "unknown"][:7] + ["human"]


def test_collect_comments(spark):
    reviews = spark.createDataFrame([(1, "alice", "x" * 50, "a.py"), (2, "alice", "x" * 49, "a.py")], "id long, user_login string, body string, path string")
    issues = spark.createDataFrame([(3, "copilot[bot]", "y" * 60), (4, "odd-bot", "y" * 60)], "id long, user_login string, body string")
    out = mining.collect_comments(reviews, issues)
    assert sorted((r.id, r.family, r.path) for r in out.collect()) == [(1, "human", "a.py"), (3, "copilot", None)]
    assert [tuple(r) for r in mining.family_counts(out).collect()] == [("copilot", 1), ("human", 1)]


def test_usage(spark):
    rows = [("m1", 600_000, 500_000, NOW, "f", 1.0), ("m1", 400_000, 0, NOW, "g", 2.0), ("odd", 1, 1, NOW, "f", 4.0)]
    df = spark.createDataFrame(rows, "model string, input_tokens long, output_tokens long, start_time timestamp_ntz, function_name string, credits_used double")
    rates = spark.createDataFrame([("m1", 1.5, 6.0)], "model string, input_rate double, output_rate double")
    priced, rejects = usage.usage_cost(df, rates)
    assert [(r.model, r.requests, r.estimated_usd) for r in priced.collect()] == [("m1", 2, 4.5)]
    assert [r.model for r in rejects.collect()] == ["odd"]
    assert [tuple(r) for r in usage.usage_by_day(df, ["f"]).collect()] == [(NOW.date(), 2, 5.0)]


def test_no_families_rules_or_labels(spark):
    row = spark.range(1).select(
        mining.trigger(F.lit("no, that's wrong"), []).alias("a"),
        mining.trigger(F.lit("anything"), [("x", "high", [])]).alias("b"),
        mining.author_family(F.lit("new[bot]"), []).alias("c"),
        mining.author_family(F.lit(None).cast("string"), []).alias("d"),
    ).first()
    assert tuple(row) == (None, None, "unknown", "human")
