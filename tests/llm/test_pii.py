import hashlib
import random
import re

from spanlab.llm import pii

from .conftest import SF, docs_of

ORDER = ["email", "ip", "card", "phone"]


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for k, p, ok in ((2, r"[0-9]([\x20-]?[0-9])+", lambda d: 12 <= len(d) <= 19 and luhn(d)), (3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 9 <= len(d) <= 15)):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, t) if ok(re.sub("[^0-9]", "", m.group()))]
    return ",".join(f"{ORDER[k]}:{a}:{b}" for a, k, b in sorted(out)), [sum(o[1] == k for o in out) for k in range(4)]


def check(got, rows):
    for i, t in rows:
        text, n = base(t or "")
        x = got[i]
        assert x.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == n
        assert set(filter(None, text.split(","))) <= set(x.spans.split(","))


def test_documents_against_re(spark):
    got = {r.doc_id: r for r in pii.query(spark, SF).collect()}
    check(got, [(r[0], r[1]) for r in docs_of()])


def test_random_texts_against_re(spark, make):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("aB.@@--+ 1234567890..  ()é😀\n_%") for _ in range(rng.randint(0, 90)))) for k in range(1500)]
    rows += [(k + 2000, "".join(rng.choice("0123456789-. +(") for _ in range(rng.randint(0, 150)))) for k in range(1500)]
    rows += [(9001, "1" * 30000), (9002, "1 " * 15000), (9003, "a" * 20000 + "@b.c"), (9004, "a@" + "b." * 9000 + "c"), (9005, None), (9006, "")]
    got = {r.doc_id: r for r in pii.digest(pii.find(make(rows))).collect()}
    check(got, rows)


def test_weak_labels_add_and_plan_has_no_python(spark, make):
    rows = [(k, f"some words write to mail bob{k}@site{k}.com or call tel +49 30 55512{k % 10}{k % 7} and then") for k in range(40)]
    rows += [(100 + k, f'then password = "a{k}b2c3d4e5f6a7b8" was set') for k in range(30)]
    rows += [(200 + k, "plain invented words without anything to find at all") for k in range(30)]
    df = make(rows)
    found = pii.find(df)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    got = {r.doc_id: r for r in pii.digest(found).collect()}
    assert all(got[k].n_email == 1 and got[k].n_phone == 1 for k in range(40))
    assert all("secret:" in got[100 + k].spans for k in range(30))
    assert all(got[200 + k].spans == "" for k in range(30))
    assert all(r.n_spans == len([x for x in r.spans.split(",") if x]) for r in got.values())
    red = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert red[3].startswith("some words write to mail [email] or call tel [phone]")


def test_odd_and_empty(odd, make):
    assert pii.digest(pii.find(odd)).count() == odd.count()
    assert pii.digest(pii.find(make([]))).count() == 0
