import random
import zlib

import pytest
from llm_cases import documents, empty, words

from kestrel.llm import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def counts(spark):
    return toxicity.trigram_counts(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture(scope="module")
def restorer(counts):
    return toxicity.Restorer(counts)


def test_trigram_counts_plain(spark):
    got = toxicity.trigram_counts(spark.createDataFrame([("Ab  c",), (None,), ("",), ("ab",)], "text string"))
    # a = 1, b = 2, c = 3, word border = 0
    assert [got[(x * 61 + y) * 61 + z] for x, y, z in ((0, 1, 2), (1, 2, 0), (2, 0, 3), (0, 3, 0), (1, 2, 3))] == [2, 2, 1, 1, 0]


@pytest.mark.parametrize("disguised,word", [
    ("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"),
    ("tr4sh", "trash"), ("w0rthl3ss", "worthless"), ("mоrоn", "moron"), ("lo-ser", "loser"), ("stupiiiid!!", "stupid")])
def test_restores_disguised_words(restorer, disguised, word):
    assert word in restorer.words("it is " + disguised + " and")


def test_restores_spaced_words_and_leaves_plain_ones(restorer):
    assert "moron" in restorer.words("you are a m o r o n today")
    assert restorer.words("plain words stay here") == {"plain": 1, "words": 1, "stay": 1, "here": 1}


def test_viterbi_finds_the_cheapest_path(restorer):
    """Against all paths of the lattice, one by one."""
    import itertools
    ch = restorer.channel

    def cost(path):
        p = q = 0
        total = 0.0
        for x, c in [*path, (" ", 0.0)]:
            total += c
            for s in x:
                k = toxicity._class(s)
                total += ch.cost[(p * 61 + q) * 61 + k]
                p, q = q, k
        return total

    for w in ("1d10t", "a55", "h3ll0", "s-a-d", "coool"):
        best = min(itertools.product(*ch.lattice(w)), key=cost)
        assert ch.decode(w) == "".join(x for x, _ in best).strip()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    hit = [(r["toxic"], r["predicted"]) for r in rows]
    assert sum(t and p for t, p in hit) >= 0.92 * sum(t for t, _ in hit)
    assert sum(p and not t for t, p in hit) <= 0.01 * sum(not t for t, _ in hit)


def test_edge_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 1), (4, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    d = documents(spark)
    out = toxicity.toxicity(d, labels).collect()
    assert len(out) == d.count() and all(0 <= r["score"] <= 1 for r in out)
    none = toxicity.toxicity(d, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0} and {r["predicted"] for r in none} == {0}
    assert toxicity.toxicity(empty(spark), labels).count() == 0
    assert toxicity.drop_toxic(d, labels.limit(0)).count() == d.count()


def test_learns_rare_roots_and_keeps_clean_documents(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        t = words(1000 + i, 60).split(" ")
        bad = i % 9 == 0
        if bad:
            for _ in range(3):
                t[r.randrange(60)] = "vrq" + "".join(r.choice("abcde") for _ in range(4))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {x["doc_id"]: x["predicted"] for x in toxicity.toxicity(d, lab).where("held_out").collect()}
    assert sum(got[i] == labels[i][1] for i in got) >= 0.97 * len(got)
    assert not any(p for i, p in got.items() if not labels[i][1])


@pytest.mark.parametrize("disguised,word", [
    ("a$$", "ass"), ("@$$hole", "asshole"), ("sh!+", "shit"), ("!diot", "idiot"), ("@$$", "ass"), ("455", "ass"),
    ("idi" + "o" * 40 + "t", "idiot"), ("iiddiioott", "idiot"), ("idioot", "idiot"), ("$tup1d***", "stupid")])
def test_no_position_is_settled_before_decoding(restorer, disguised, word):
    assert word in restorer.words("it is " + disguised + " and")


def test_marks_are_as_many_positions_as_letters_and_words_of_any_length_are_decoded(restorer):
    ch = restorer.channel
    assert len(ch.lattice("f" + "*" * 7 + "k")) == 9
    assert len(ch.decode("m****n", keep=True)) == 6
    assert any(w.startswith("idiotidiot") for w in restorer.words(".".join("idiot" * 20)))
    assert len(ch.decode("a1" * 20_000)) == 40_000


def test_any_letter_positions_agree_with_all_paths(restorer):
    import itertools
    ch = restorer.channel

    def cost(path):
        p = q = 0
        total = 0.0
        for x, c in [*path, (" ", 0.0)]:
            total += c
            for s in x:
                k = toxicity._class(s)
                total += ch.cost[(p * 61 + q) * 61 + k]
                p, q = q, k
        return total

    for w in ("m*r*n", "s#t", "ab**", "iidd"):
        best = min(itertools.product(*ch.lattice(w)), key=cost)
        assert ch.decode(w) == "".join(x for x, _ in best).strip()


@pytest.mark.parametrize("token", [
    "stop.idiot", "you...idiot", "total-idiot", "you,idiot", "you/idiot", "you—idiot", "stop!idiot", "you|idiot",
    "you_idiot", "idiot's", "(you):idiot", "you.1d10t", "such-an-idiooot,really"])
def test_words_glued_by_marks_are_read_on_their_own(restorer, token):
    assert "idiot" in restorer.words("it is " + token + " and")


def test_marks_inside_a_token_may_be_borders_and_accents_cut_no_word(restorer):
    assert all((" ", toxicity._SPLIT) in restorer.channel.lattice(f"stop{c}idiot")[4] for c in ".-_*~'!")
    assert "loser" in restorer.words("a lo-ser")
    assert restorer.words("cafés") == {"cafés": 1}


def test_words_that_cannot_have_a_known_feature_are_not_decoded(counts, monkeypatch):
    weights = {"1=moron": 3.0, "2=moron": 3.0, "1idio": 2.0, "1=bad": 2.5, "1été": 2.0}
    r = random.Random(4)
    tokens = [a + "".join(r.choice(["e", "o", "oo", "d", "ll", "é", "tt", "x"]) for _ in range(r.randint(0, 5))) + b
              for _ in range(1500) for a in ("", "mor", "iidi", "ba", "b", "\"moo", "étté", "mоr") for b in (r.choice(["", "!!", "***", ",", "$", ".&&"]),)]
    pruned, whole = (toxicity.Scorer(counts, -1.0, weights) for _ in range(2))
    monkeypatch.setattr(whole, "_may_speak", lambda token: True)
    assert [pruned.score(t) for t in tokens] == [whole.score(t) for t in tokens]
    assert len({pruned.score(t) for t in tokens}) > 2
    decoded = []
    monkeypatch.setattr(pruned.restorer.channel, "decode", lambda word, *a, **k: decoded.append(word) or word)
    pruned.score("bettter queéê, lattter*** letters plain")
    assert not decoded
    pruned.score("moorron")
    assert decoded
