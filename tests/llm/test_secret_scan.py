"""Secret scan: base spans by a plain reading of the rules, transition counts by hand, held-out keys."""

import hashlib
import random
import re
import string

import numpy as np

from pulse.llm import secret_scan as S

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def row(doc_id, text):
    found = base(text or "")
    spans = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return (doc_id, *[sum(k == x for _, k, _ in found) for x in range(3)], hashlib.sha256(spans.encode()).hexdigest(), spans)


WORDS = ("configuration database_connection getUserName the_quick_brown fox jumps over lazy dog http handler request response "
         "internationalization parseDocument write_output total_count 20240115 1234567890123456 encodeURIComponent maxRetries").split()


def ordinary(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def key(rng, n, alphabet=string.ascii_letters + string.digits):
    return "".join(rng.choice(alphabet) for _ in range(n))


def documents(seed=7, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        parts = [ordinary(rng, rng.randint(1, 60))]
        if i % 3 == 0:
            parts.append(rng.choice(["token = \"{}\"", "PassWord: '{}'", "api-key={} api_key={}", "ApiKey\":\"{}"]).replace("{}", key(rng, rng.randint(8, 40))))
        if i % 5 == 0:
            parts.append("é日本 " + key(rng, rng.randint(10, 40), "0123456789abcdef") + "é")
        if i % 7 == 0:
            parts.append("xAKIA" + key(rng, rng.randint(10, 18), string.ascii_uppercase + string.digits) + "\nAKIAAKIA")
        rng.shuffle(parts)
        out.append((i, rng.choice([" ", "\n", "é", "\U0001f600"]).join(parts)))
    return out


def test_base_spans(spark, frame, same_rows):
    docs = documents() + [(None, None), (900, ""), (900, "secret: token: abcdefghijklmnop"), (901, "toKen=abcdefghijklmnop toKEN=abcdefghijkl")]
    docs += [(902, "token=" + "ab12" * 200_000 + " AKIA" + "A" * 13), (903, "password=aaaaaaaaaaa\npassword=aaaaaaaaaaaa"), (904, "secret\" = 'k" + "=" * 11)]
    docs += [docs[0]] * 2
    got = S.scan(frame(docs).repartition(3), threshold=1e9).collect()  # no additions: what is left are the base spans
    same_rows([tuple(r) for r in got], [row(i, t) for i, t in docs])


def test_empty_and_other_columns(spark, frame):
    assert S.scan(frame([])).count() == 0
    df = frame([(1, "token=abcdefghijkl", "x", 2)], "doc_id int, text string, spans string, random int")
    assert [r.spans for r in S.scan(df).collect()] == ["assign:0:18"]


def test_transition_counts(spark, frame):
    docs = documents(n=60) + [(None, None), (1, "")]
    want = {}
    for _, text in docs:
        text = text or ""
        rule, secret = set(), set()
        for m in re.finditer(ASSIGN, text):
            if len(m[2]) >= 12:
                rule |= set(range(m.start(), m.end()))
                secret |= set(range(m.start(2), m.end(2)))
        for a, k, b in base(text):
            if k:
                rule |= set(range(a, b))
                secret |= set(range(a, b))
        for label, inside in ((True, lambda i: i in secret), (False, lambda i: i not in rule)):
            states = [0, *[S.LETTERS.find(c) + 1 if inside(i) else 0 for i, c in enumerate(text)], 0]
            for pair in zip(states, states[1:]):
                if pair != (0, 0):
                    want[(label, *pair)] = want.get((label, *pair), 0) + 1
    got = {(r.random, r.a, r.b): r.n for r in S.sample_counts(frame(docs).repartition(4)).collect()}
    assert got == want


def test_held_out_keys(spark, frame):
    """Keys of other alphabets than the samples' and in no known form are found; identifiers, numbers and
    paths of words are not."""
    ratio = S.train(frame(documents()))
    rng = random.Random(99)
    planted, clean = [], []
    for i in range(100):
        k = key(rng, rng.randint(24, 44), rng.choice([string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
                                                      string.ascii_uppercase + "234567"]))
        text = f"{ordinary(rng, 5)} auth({k}) {ordinary(rng, 5)}"
        planted.append((i, text, text.index(k), len(k)))
        clean.append((1000 + i, f"{ordinary(rng, 20)} {'_'.join(rng.sample(WORDS, 3))}"))
    got = {r.doc_id: r.spans for r in S.scan(frame([p[:2] for p in planted] + clean), ratio=ratio).collect()}
    assert sum(f"random:{a}:{a + n}" in got[i] for i, _, a, n in planted) >= 95
    assert sum("random" in got[i] for i, _ in clean) <= 2


def test_additions_leave_base_spans(spark, frame):
    docs = documents()
    for r in S.scan(frame(docs), threshold=0.0).collect():
        assert ",".join(x for x in r.spans.split(",") if x and not x.startswith("random")) == row(*docs[r.doc_id])[-1]
    text = docs[0][1]
    matrix = np.zeros((S.STATES, S.STATES))
    assert all("random" not in r.spans for r in S.scan(frame([(0, text)]), threshold=0.0, ratio=matrix).collect())  # a tie is ordinary
