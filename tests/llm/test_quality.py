import subprocess
import sys

import numpy as np
import pytest

from rillmark.llm import quality
from rillmark.llm.base import table
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward


def plain_score(net, text):
    """Window by window and chunk by chunk."""
    size = max(2, -(-len(text) // 4))
    data = text.ljust(4 * size, b"\0")
    read = lambda i: net.vectors[list(data[4 * i : 4 * i + 4])].reshape(-1)
    windows = [read(i) @ net.filters[0] + read(i + 1) @ net.filters[1] for i in range(size - 1)]
    act = np.array([np.tanh(np.max(windows[i : i + quality.CHUNK], 0) + net.bias) for i in range(0, len(windows), quality.CHUNK)])
    z = (np.stack([act.mean(0), act.min(0), act.max(0)]) * net.weights).sum() + net.offset
    return 1 / (1 + np.exp(-z))


TEXTS = [b"", b"a", b"12345678", b"word " * 500, bytes(range(256)) * 9, b"x" * 508, b"x" * 509, b"y" * 100_000]


def test_scores_against_plain_windows():
    net = quality.Network.fresh()
    assert net.score(TEXTS).tolist() == pytest.approx([plain_score(net, t) for t in TEXTS], abs=1e-5)


def test_a_long_text_is_read_piece_by_piece(monkeypatch):
    net = quality.Network.fresh()
    texts = [bytes(np.random.default_rng(n).integers(0, 256, n, np.uint8)) for n in (1007, 1008, 1009, 2016, 5000, 12_345)] + TEXTS
    whole = net.score(texts)
    for piece in (504, 1008, 3000):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert net.score(texts).tolist() == pytest.approx(whole.tolist(), abs=1e-6)


def test_memory_of_a_very_long_text():
    """A worker's peak over a text of 64 MB, the text and its copy in Arrow included."""
    script = (
        "import resource, numpy as np\n"
        "from rillmark.llm import quality\n"
        "net = quality.Network.fresh()\n"
        "text = b'some words of a very long text ' * (64_000_000 // 31)\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "assert 0 < net.score([text])[0] < 1\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    )
    grown = int(subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True).stdout)
    assert grown < 300_000


def test_gradients_against_differences():
    net = quality.Network.fresh()
    net.vectors, net.filters, net.weights = (a.astype(np.float64) for a in (net.vectors, net.filters, net.weights))
    texts, truth, weight = TEXTS[2:5], np.array([1, 0, 1]), np.array([0.5, 1.0, 0.25])

    def loss():
        p = net.score(texts)
        return -(weight * np.log(np.where(truth == 1, p, 1 - p))).sum()

    grads = net.gradients(texts, truth, weight)
    for array, grad, at in [(net.weights, grads[3], (1, 3)), (net.filters, grads[1], (0, 5, 7)), (net.filters, grads[1], (1, 9, 2)), (net.vectors, grads[0], (ord("w"), 2))]:
        kept, sides = array[at], []
        for move in (1e-6, -1e-6):
            array[at] = kept + move
            sides.append(loss())
        array[at] = kept
        assert grad[at] == pytest.approx((sides[0] - sides[1]) / 2e-6, rel=2e-2, abs=1e-4)


def test_held_out_rows(spark):
    labels = table(spark, SF_CHECK, "labels")
    found = quality.report(table(spark, SF_CHECK, "documents"), labels).where("held_out").join(labels, "doc_id").toPandas()
    order, good = found["score"].rank(), found["quality"] == 1
    n1, n0 = good.sum(), (~good).sum()
    assert (order[good].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.93


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 1)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 8)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = awkward(spark, "score", "predicted", "held_out", "quality")
    got = quality.report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert quality.report(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.report(docs, labels.limit(0)).collect()} == {0.5}
