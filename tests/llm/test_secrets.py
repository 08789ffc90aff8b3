import hashlib
import random
import re
import time

from acervo.llm import secrets

P = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(t):
    t = t or ""
    s = [(m.start(), 0, "assign", m.end()) for m in P.finditer(t) if len(m[2]) >= 12]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    s += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(s))
    return [sum(x[1] == i for x in s) for i in range(3)], hashlib.sha256(said.encode()).hexdigest(), said


def test_base_equals_plain_python(spark):
    rng = random.Random(5)
    bits = ["password", "ToKen", "api_key", "APIKEY", "ſecret", "toKen", "=", ": ", '"', "'", " ", "\n\n", "\n", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "secret:", "é", "😀", ".", "-", "x" * 12, "user=bob", "https://h.example/x"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(400)] + [(None, "token=" + "a" * 12), (7, None), (8, ""), (9, "x " * 100_000 + "f" * 16), (9, "x")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, parts string")
    got = secrets.scanned(docs).collect()
    assert sorted((str(r.doc_id), [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in got) == sorted((str(i), *base(t)[:2]) for i, t in rows)
    strong = lambda s: ",".join(x for x in s.split(",") if x.split(":")[0] in secrets.KINDS)
    assert sorted((str(r.doc_id), strong(r.spans)) for r in got) == sorted((str(i), base(t)[2]) for i, t in rows)
    assert secrets.scanned(docs.limit(0)).count() == 0


def test_weak_parts_need_complements(spark):
    far = " word" * 100
    rows = [(1, "password=hunter2"), (2, "user=alice password=hunter2"), (3, "user=alice\n\npassword=hunter2"), (4, "user=alice" + far + " password=hunter2"), (5, "https://db.example/x user=alice password=hunter2"), (6, "see https://db.example/x"), (7, "user=alice token=abcdefghijklmnop")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in secrets.scanned(docs).collect()}
    assert got == {1: [], 2: ["weak_id", "weak_secret"], 3: [], 4: [], 5: ["endpoint", "weak_id", "weak_secret"], 6: [], 7: ["weak_id", "assign"]}


def test_linking_equals_all_pairs(spark):
    rng = random.Random(8)
    roles = {"weak_secret": "secret", "weak_id": "id", "endpoint": "endpoint", "assign": "secret", "access": "id"}
    rows = []
    for row in range(60):
        found = {}
        for _ in range(rng.randint(0, 14)):
            kind, start = rng.choice(list(roles)), rng.choice([0, 5, 40, rng.randrange(3000)])
            found[kind, start, start + rng.choice([3, 10, 400, 900])] = rng.randrange(2)
        rows.append((row, 0, 0, 0, "", [(k, roles[k], k in secrets.KINDS, a, b, scope) for (k, a, b), scope in found.items()]))
    docs = spark.createDataFrame(rows, f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, parts {secrets.PARTS}")

    def holds(p, parts):
        gap = lambda q: q[3] - p[4] if (p[3], p[4], p[0]) < (q[3], q[4], q[0]) else p[3] - q[4]
        near = {q[1] for q in parts if q is not p and q[5] == p[5] and gap(q) <= secrets.REACH}
        return p[2] or {"secret": bool(near & {"id", "endpoint"}), "id": "secret" in near, "endpoint": {"id", "secret"} <= near}[p[1]]

    want = {r[0]: sorted(f"{p[0]}:{p[3]}:{p[4]}" for p in r[5] if holds(p, r[5])) for r in rows}
    got = {r.doc_id: sorted(x for x in r.spans.split(",") if x) for r in secrets.linked(docs).collect()}
    assert got == want and 100 < sum(map(len, want.values())) < sum(len(r[5]) for r in rows)


def test_many_parts_in_one_paragraph_take_seconds(spark):
    docs = spark.createDataFrame([(1, "user=alice password=hunter2 " * 25_000)], "doc_id long, text string")
    began = time.time()
    assert secrets.scanned(docs).first().n_linked == 50_000
    assert time.time() - began < 30
