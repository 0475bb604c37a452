import random
import re

from rillmark.llm import secrets
from rillmark.llm.base import table
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, rows


def plain_base(text):
    """The three kinds by the patterns as stated, without the library's shortcuts."""
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    found = []
    for order, (kind, pattern, group, least) in enumerate(
        [
            ("assign", "(" + letters + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", "AKIA[A-Z0-9]+", 0, 20),
            ("hex", "[0-9a-f]+", 0, 24),
        ]
    ):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(start, end, kind) for start, _, kind, end in sorted(found)]


def test_base_spans_of_all_documents(spark):
    texts = [r.text for r in table(spark, SF_CHECK, "documents").select("text").collect()]
    assert [secrets.base_spans(t) for t in texts] == [plain_base(t) for t in texts]
    assert any(secrets.base_spans(t) for t in texts)


def test_base_spans_of_hard_cases():
    cases = [
        "PassWord = 'abcdef' api_key:123456 APIKEY=12345 token\"=\"x=y=z/1",
        "toKen = abcdefg ſecret = abcdefg",
        "secret=token=abcdef secret: secret:abcdefgh",
        "AKIA" + "Z" * 16 + " AKIA" + "Z" * 15 + " AKIAAKIA" + "0" * 12,
        "0123456789abcdef01234567g89abcdef " + "f" * 23 + " " + "e" * 24,
        "😀 password=abcdef",
    ]
    assert [secrets.base_spans(t) for t in cases] == [plain_base(t) for t in cases]


def test_weak_parts_need_a_complement():
    blob = "Zx9Kq2Lm8Np4Rs6T"
    assert secrets.link(f"see {blob} there") == ([], [])
    assert secrets.link("visit https://host.example/x now")[1] == []
    text = f"user: fred\n{blob}"
    assert secrets.as_text(secrets.link(text)[1]) == "ident:0:10,blob:11:27"
    assert secrets.link(f"user: fred\n\n{blob}")[1] == []
    assert secrets.link(f"user: fred {'x ' * 200}{blob}")[1] == []
    text = "token = abcdefgh at db://host/name"
    strong, every = secrets.link(text)
    assert (secrets.as_text(strong), secrets.as_text(every)) == ("assign:0:16", "assign:0:16,endpoint:20:34")


def test_dense_text_is_swept():
    blob = "Zx9Kq2Lm8Np4Rs6T"
    text = " ".join([blob] * 20_000 + ["user=fred"])
    assert 5 <= len(secrets.link(text)[1]) <= 30


def test_awkward_rows(spark):
    docs = awkward(spark, "spans", "n_hex")
    got = rows(secrets.scan(docs))
    assert len(got) == docs.count() and all(r[-1] == "" for r in got)
    assert secrets.scan(docs.limit(0)).collect() == []


def plain_link(text):
    """Every weak part against every part of its paragraph."""
    strong = plain_base(text)
    weak, taken = [], [(a, b) for a, b, _ in strong]
    for kind, pattern in (("endpoint", secrets.ENDPOINT), ("ident", secrets.IDENT), ("blob", secrets.BLOB)):
        found = [m for m in pattern.finditer(text) if not any(a < m.end() and m.start() < b for a, b in taken)]
        if kind == "blob":
            found = [m for m in found if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        weak += [(*m.span(), kind) for m in found]
        taken += [m.span() for m in found]
    borders = [m.start() for m in secrets.SCOPE_END.finditer(text)]
    scope = lambda at: sum(b < at for b in borders)
    needs = {"ident": {"assign", "hex", "blob"}, "blob": {"access", "ident", "endpoint"}, "endpoint": {"assign", "hex", "blob", "access", "ident"}}
    reported = [
        (a, b, kind)
        for a, b, kind in weak
        if any(k in needs[kind] and scope(c) == scope(a) and c < b + secrets.REACH and d > a - secrets.REACH for c, d, k in strong + weak)
    ]
    order = [*secrets.KINDS]
    return sorted(strong + reported, key=lambda s: (s[0], order.index(s[2]), s[1]))


def test_links_against_all_pairs():
    draw = random.Random(6)
    pieces = ["user: fred", "Zx9Kq2Lm8Np4Rs6T", "https://host.example/x", "token = abcdefgh", "AKIA" + "Q1" * 9, "0123456789abcdef01234567", "\n\n", "\n", "client_id=abc", "password: short", "x" * 100, "plain words", "key_id=Zx9Kq2Lm8Np4Rs6T", "wss://Zx9Kq2Lm8Np4Rs6T"]
    seen = 0
    for _ in range(600):
        text = draw.choice([" ", "", "\n"]).join(draw.choice(pieces) for _ in range(draw.randrange(1, 14)))
        assert secrets.link(text)[1] == plain_link(text), text
        seen += len(secrets.link(text)[1]) - len(secrets.link(text)[0])
    assert seen > 300
