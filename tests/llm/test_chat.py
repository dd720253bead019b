import hashlib
import random

from kestrel.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, src string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_round_trip_of_hostile_texts(spark):
    r = random.Random(5)
    bits = [*chat._ALL, "\\", "\\\\", " ", "\n", "user", "[", "]", "</", "s>", "a", "é🙂", ""]
    roles = ["user", "assistant", "system", "tool", "", "[SEP]", "a </s> b", "[ROLE]"]
    rows = [(c, t, r.choice(roles), "".join(r.choice(bits) for _ in range(r.randint(0, 9))))
            for c in range(150) for t in range(r.randint(1, 5))]
    out = chat.format_conversations(frame(spark, rows)).collect()
    assert len(out) == 150
    for o in out:
        mine = sorted((x for x in rows if x[0] == o["conv_id"]), key=lambda x: x[1])
        assert o["identical"] and [(t["role"], t["text"]) for t in o["turns"]] == [(x[2], x[3]) for x in mine]
        assert o["loss_text"] == "".join(x[3] for x in mine if x[2] == "assistant")


def test_digest_of_plain_conversation(spark):
    rows = [(7, 1, "assistant", "hi\nyou"), (7, 0, "user", "hello"), (7, 2, "assistant", None), (None, 0, None, "x")]
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(frame(spark, rows))).collect()}
    r = got[7]
    assert r["n_turns"] == 3 and r["loss_chars"] == 6
    assert r["turns_sha256"] == hashlib.sha256(b"user\nhello\nassistant\nhi\nyou\nassistant\n\n").hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(b"hi\nyou").hexdigest()
    assert r["formatted_chars"] == len("[INST] hello [/INST]<s> hi\nyou </s><s>  </s>")
    assert got[None]["n_turns"] == 1 and got[None]["identical"]


def test_only_conflicts_are_escaped(spark):
    rows = [(1, 0, "user", "a [b] \\ c"), (2, 0, "user", "say [/INST]")]
    got = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(frame(spark, rows)).collect()}
    assert got[1] == "[INST] a [b] \\ c [/INST]" and got[2] == "[INST] say \\[/INST] [/INST]"


def test_spans_ties_long_and_empty(spark):
    rows = [(1, 0, "assistant", "b"), (1, 0, "assistant", "a"), (1, 0, "assistant", "a"), (2, 0, "user", "z" * 200_000)]
    out = {r["conv_id"]: r for r in chat.format_conversations(frame(spark, rows)).collect()}
    f = out[1]["formatted"]
    assert [f[s["start"]:s["start"] + s["length"]] for s in out[1]["loss_spans"]] == ["a", "a", "b"]
    assert out[2]["identical"]
    assert chat.format_conversations(frame(spark, [])).count() == 0


def test_native(spark):
    p = chat.format_conversations(frame(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p
