import hashlib
import random

import public_tokenizers
import pytest
from llm_cases import documents, empty

from kestrel.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def voc():
    return pieces.Vocabulary(MODEL)


def test_agenda_against_library(voc):
    r = random.Random(3)
    signs = "abcdefghnorstu ▁ \t\nétion the漢🙂0123 '\x00   AB<>/s​"
    for _ in range(1500):
        s = "".join(r.choice(signs) for _ in range(r.randint(0, 70)))
        ids = voc.library.encode(s)
        assert voc.encode(s) == ids and voc.decode(ids) == voc.library.decode(ids)
        assert [i for u in voc.units(s) for i in voc._ids(voc.agenda(u))] == ids  # the scalar agenda agrees


@pytest.mark.parametrize("s", ["", " ", "▁", "▁▁▁▁▁", " " * 100, "</s><s>", "<0x41>", "a" * 500, "é" * 80, "the " * 200])
def test_special_texts(voc, s):
    assert voc.encode(s) == voc.library.encode(s)
    assert voc.decode(voc.encode(s)) == voc.library.decode(voc.library.encode(s))


def test_decode_of_any_ids(voc):
    r = random.Random(4)
    for _ in range(300):
        ids = [r.choice([1, 2, 259, 260, r.randint(261, 31999)]) for _ in range(r.randint(1, 9))]
        ids = [i for i in ids if i not in (1, 2)] or [300]
        assert voc.decode(ids) == voc.library.decode(ids)


def test_documents(spark, voc):
    d = documents(spark)
    full = pieces.encode_documents(d, MODEL).collect()
    short = pieces.encode_documents(d, MODEL, digest=True).collect()
    assert len(full) == d.count() == len(short)
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in d.collect())
    exp = sorted((i, voc.library.encode(t), voc.library.decode(voc.library.encode(t)) if t else "") for i, t in texts)
    assert sorted((r["doc_id"] or -1, r["ids"], r["decoded"]) for r in full) == exp
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in short) == sorted(
        (i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(),
         hashlib.sha256(t.encode()).hexdigest()) for i, x, t in exp)
    assert pieces.encode_documents(empty(spark), MODEL).count() == 0


def test_memory_of_units_is_bounded(voc, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    for k in range(20):
        voc.learn({f"▁w{k}x{j}" for j in range(30)}, True)
        assert len(voc.known) <= 110 and f"▁w{k}x3" in voc.known


def test_differences_from_the_library_end_the_job(voc, monkeypatch):
    """A wrong encoding and a wrong decoding are both found, unit by unit."""
    fresh = pieces.Vocabulary(MODEL)
    monkeypatch.setattr(fresh, "_texts", lambda units, ids: [" other" for _ in units])
    with pytest.raises(ValueError, match="differ"):
        fresh.learn({"▁decoded"}, True)
    fresh = pieces.Vocabulary(MODEL)
    monkeypatch.setattr(fresh, "encode_units", lambda units: [[300] for _ in units])
    with pytest.raises(ValueError, match="differ"):
        fresh.learn({"▁encoded"}, True)
    fresh.learn({"▁encoded"}, False)
    assert fresh.ids_of(["▁encoded"] * 2) == "300,300" and fresh.text_of(["▁encoded"]) == fresh.pieces_text([300])[1:]


def test_units_that_decode_to_something_else(voc, monkeypatch):
    """Characters that no piece has come back from their bytes; a control piece has no text."""
    monkeypatch.setattr(voc, "encode_units", lambda units: [[1, 300] if u == "▁s" else pieces.Vocabulary.encode_units(voc, [u])[0]
                                                            for u in units])
    voc.learn({"▁s", "▁漢🙂", "▁a\n"}, False)
    assert voc.changed["▁s"] == voc.pieces_text([1, 300]) and "▁漢🙂" not in voc.changed
    assert voc.text_of(["▁a\n", "▁s", "▁漢🙂"]) == "a\n" + voc.changed["▁s"] + " 漢🙂"
    voc.known.clear()
    voc.changed.clear()
