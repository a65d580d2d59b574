from __future__ import annotations

import hashlib
import random
import re

from etoile.llm import sanitise
from llm_helpers import documents

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else True,
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m.group())] for k, p in KINDS.items()}


def test_base_spans_equal_the_patterns():
    rnd = random.Random(2)
    alphabet = "a1.@-+ 0(5)%é4"
    for _ in range(20_000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert sanitise.base_spans(t) == base(t), t
    for t in ("x 4111 1111 1111 1111, 4111-1111-1111-1112", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "+49 (30) 1234-5678.", "a@b.c@d.e f@g h%i@j.k-l.",
              "1" * 5000, "a" * 5000 + "@", "1." * 3000, "@" * 3000, "+1" * 2000):
        assert sanitise.base_spans(t) == base(t)


def rows_with_disclosure():
    rnd = random.Random(4)
    words = [f"term{i:03d}" for i in range(200)]
    rows = []
    for i in range(60):
        body = " ".join(rnd.choice(words) for _ in range(30))
        if i % 10 == 0:
            body += f" the zorblax account of ann.lee@mail.example.com is open {i}"       # zorblax and account stand only beside the address
        rows.append((i, body))
    rows += [(100, "Zorblax again, without the address é zorblax"), (101, rows[10][1]), (102, None), (103, ""), (None, rows[20][1])]
    return rows


def test_terms_that_reveal_an_entity_are_spans(spark):
    rows = rows_with_disclosure()
    out = {(r.doc_id, r.digest): r for r in sanitise.find_spans(documents(spark, rows), min_bits=2.0).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        r = out[i, sanitise._digest(t or "")]
        b = base(t or "")
        joined = ",".join(f"{k}:{a}:{e}" for k in KINDS for a, e in b[k])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(b[k]) for k in KINDS)
        assert r.spans.startswith(joined)
        terms = {(t or "")[p.starts:p.ends].lower() for p in r.terms}
        assert terms <= {"zorblax", "account", "open"} and ("zorblax" in terms) == ("zorblax" in (t or "").lower())
        extra = [f"term:{p.starts}:{p.ends}" for p in r.terms]
        assert r.spans == ",".join([x for x in [joined] if x] + extra)


def test_counts_are_over_distinct_texts(spark):
    rows = [(i, "plonk of bob@x.example.org stands here") for i in range(50)] + [(100 + i, f"other words {i} entirely") for i in range(50)]
    assert all(not r.terms for r in sanitise.find_spans(documents(spark, rows)).collect())


def test_sanitised_text(spark):
    rows = rows_with_disclosure()
    out = {r.doc_id: r.text for r in sanitise.sanitise(documents(spark, rows), min_bits=2.0).collect()}
    assert "ann.lee" not in out[0] and "[EMAIL]" in out[0] and "zorblax" not in out[0]
    assert "orblax" not in out[100] and "without the address é" in out[100]
    assert out[102] == "" and out[1] == rows[1][1]
    assert sanitise.find_spans(documents(spark, [])).collect() == []


def test_short_names_and_codes_are_terms(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["ann", "The", "of", "lee", *(f"word{k}" for k in range(99))]) for _ in range(40))) for i in range(400)]
    rows = [(i, t + f" Ann Lee X7Q 李 ann.lee@mail.example.com {i} was here") if i % 80 == 0 else (i, t) for i, t in rows]
    rows += [(900, "so Ann and X7Q met"), (901, "so ann and x7q met")]
    out = {r.doc_id: r for r in sanitise.find_spans(documents(spark, rows)).collect()}
    found = {i: {t[p.starts:p.ends] for p in out[i].terms} for i, t in rows}
    assert found[80] >= {"Ann", "Lee", "X7Q", "李"} and not found[80] & {"ann", "The", "of", "lee"}
    assert found[900] == {"Ann", "X7Q"} and found[901] == set()


def test_terms_beside_an_entity_of_a_third_of_the_texts(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(f"word{rnd.randrange(30)}" for _ in range(30)) + (" zorblax hot@x.example.org" if i % 3 == 0 else "")) for i in range(90)]
    out = sanitise.find_spans(documents(spark, rows)).collect()
    terms = {r.doc_id: {rows[r.doc_id][1][p.starts:p.ends] for p in r.terms} for r in out}
    assert all(terms[i] == ({"zorblax"} if i % 3 == 0 else set()) for i, _ in rows)
