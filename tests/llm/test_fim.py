import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rillmark.llm import fim
from tests.llm.helpers import awkward, rows

SCHEMA = "doc_id bigint, text string"


def plain(doc_id, text, rate=100, first=50):
    """n, form, prefix_chars, middle_chars, output by slicing strings."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


PIECES = ["a", "bc", "\n", "\n\n", "é", "😀", "<", "P>", "<S", ">", "<P>", "<M>", "<X>", "\r", " "]


def texts(n, seed, least=0):
    draw = random.Random(seed)
    return [(i, "".join(draw.choice(PIECES[: 10 if i % 3 else None]) for _ in range(draw.randrange(least, 30)))) for i in range(n)]


@pytest.mark.parametrize("rate, first", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_texts_are_cut_and_restored(spark, rate, first):
    docs = [*texts(400, 3), (None, "x\ny"), (1, None), (2, ""), (3, "<\n<P\n<S")]
    frame = spark.createDataFrame(docs, SCHEMA)
    filled = fim.fill_in_middle(frame, rate=rate, suffix_first=first)
    assert rows(filled) == sorted(((d, *plain(d, t, rate, first)) for d, t in docs), key=repr)
    assert rows(fim.restore(filled, ["doc_id"])) == sorted(((d, t or "") for d, t in docs), key=repr)


@pytest.mark.parametrize("window", [1, 2, 3, 7, 1 << 18])
def test_windows_and_groups_of_any_size(monkeypatch, window):
    monkeypatch.setattr(fim, "WINDOW", window)
    monkeypatch.setattr(fim, "GROUP", 5 * window)
    docs = texts(60, 9)
    held = pa.array(["skipped", *(t for _, t in docs)], pa.string()).slice(1)
    for first, last, group in fim._groups(held):
        mine = docs[first:last]
        draws = np.array([[int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for d, _ in mine] for i in range(4)])
        lines, form, cuts = group.cut(draws, 100, 50)
        outputs = fim._strings(*group.scatter(form, cuts))
        expected = [plain(d, t) for d, t in mine]
        assert [(n, fim.FORMS[f]) for n, f in zip(lines, form, strict=True)] == [e[:2] for e in expected]
        assert outputs.to_pylist() == [e[4] for e in expected]
        chars = [(int(p), int(m)) for p, m in zip(*group.characters(cuts), strict=True)]
        assert [c for c, e in zip(chars, expected, strict=True) if e[1] != "plain"] == [e[2:4] for e in expected if e[1] != "plain"]
        (back,) = (g for _, _, g in [next(fim._groups(outputs))]) if window > 7 else (fim.Group(np.frombuffer("".join(e[4] for e in expected).encode(), np.uint8), np.cumsum([0, *(len(e[4].encode()) for e in expected)])),)
        assert fim._strings(*back.gather(form)).to_pylist() == [t for _, t in mine]


def test_awkward_rows_and_columns(spark):
    docs = awkward(spark, "n", "form", "output", "h1", "t")
    found = fim.report(docs)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [(r.doc_id, *(p := plain(r.doc_id, r.text))[:4], sha(p[4]), sha(r.text or "")) for r in docs.collect()]
    assert rows(found) == sorted(want, key=repr)
    assert fim.report(docs.limit(0)).collect() == []


def test_a_very_long_text_moves_window_by_window(spark):
    long = ("zeile é 😀\n" * 9 + "\n") * 60_000
    docs = spark.createDataFrame([(i, long) for i in range(3)], SCHEMA)
    filled = fim.fill_in_middle(docs)
    assert {r.restored == long for r in fim.restore(filled, ["doc_id"]).collect()} == {True}
    assert rows(filled) == sorted(((i, *plain(i, long)) for i in range(3)), key=repr)


def test_outputs_that_do_not_fit_their_form_are_refused():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError, match="marks"):
        fim.Group(data, np.array([0, len(data)])).gather(np.array([fim.PSM]))
