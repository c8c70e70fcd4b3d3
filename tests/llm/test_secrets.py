"""Base spans against plain matching of the stated patterns; novelty on planted strings."""

import hashlib
import random
import re

from wattline.llm import secrets

STATED = {
    "assign": (r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
               r"""[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def stated(text):
    order = list(STATED)
    found = [(m.start(), order.index(k), f"{k}:{m.start()}:{m.end()}") for k, (p, ok) in STATED.items()
             for m in re.finditer(p, text or "") if ok(m)]
    return [s for *_, s in sorted(found)]


def check(row, text):
    base = stated(text)
    kinds = [s.split(":")[0] for s in base]
    assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds.count(k) for k in STATED)
    assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    spans = [s for s in row.spans.split(",") if s]
    assert [s for s in spans if not s.startswith("novel")] == base


def test_base_spans(odd):
    rng = random.Random(4)
    bits = ["password", "PassWd", "secret=token", "token", "api_key", "APIKEY", "ſecret", "toKen", " ", "  ", ":", "=", '"', "'",
            "abcdef", "abc", "AKIA", "AKIAAKIA", "ABCDEFGH0123456789", "0123456789abcdef", "deadbeefdeadbeefdeadbeef", "é", "\n", "😀", "x.y-z/"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25))), "en", "s", 1) for i in range(600)]
    df = odd(rows)
    for r in secrets.scan(df).collect():
        check(r, rows[r.doc_id][1])


def test_odd_rows(odd):
    df = odd()
    got = secrets.scan(df).collect()
    assert len(got) == 12 and all(r.spans == "" for r in got)
    assert secrets.scan(odd([])).count() == 0


def test_novel_strings(odd):
    hit = "auth: the bearer is Zk9xQ2vLr7TpWm4YbN8sHd3Jg6 and no more"
    word = "the client_secret configuration configuration_settings_environment_variable2 stays"
    far = "bearer " + "word " * 40 + "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    base = 'token = "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"'
    repeated = "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6 is the bearer Zk9xQ2vLr7TpWm4YbN8sHd3Jg6 again"
    other = "bearer. " + "word " * 40 + "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    got = {r.doc_id: r.spans for r in secrets.scan(odd([(i, t, "en", "s", 1) for i, t in enumerate([hit, word, far, base, repeated, other])])).collect()}
    assert got[0] == f"novel:{hit.index('Zk9')}:{hit.index(' and')}"
    token = "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    assert got[1] == "" and got[2] == f"novel:{far.index(token)}:{len(far)}"      # the same statement
    assert got[4] == f"novel:0:{len(token)},novel:{repeated.rindex(token)}:{repeated.rindex(token) + len(token)}"
    assert got[5] == ""                                                            # statements after the hint's
    assert got[3].startswith("assign") and "novel" not in got[3]


def test_shapes_of_secrets(odd):
    """Short ones, letters alone, before the hint, long after it, across the ends of the context, beside '='."""
    rng = random.Random(8)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(40))
    short, token = "Xk9vQ2mLr7Tp", "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(400))
    cases = [(f"passphrase {short}", short), (f"the bearer is {letters} here", letters), (f"{token} is the webhook", token),
             (f"the bearer {'of it ' * 9}{token} was", token), (f"{long} {'of it ' * 9} webhook", long),
             (f"webhook {'of it ' * 10}{long}", long), (f"passphrase={token}", token), (f"my_signature_{token}", token),
             (f"the signature at x={letters}==", letters + "=="), (f"private_key {short} and client_id {token}", token)]
    got = {r.doc_id: r.spans for r in secrets.scan(odd([(i, t, "en", "s", 1) for i, (t, _) in enumerate(cases)])).collect()}
    for i, (t, want) in enumerate(cases):
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s.startswith("novel")]
        assert any(a <= t.index(want) and t.index(want) + len(want) <= b for a, b in spans), (t, got[i])
        assert len(spans) == len({a for a, _ in spans})


def reach(text, last):
    """End of a context, character by character."""
    def ends(i):
        return text[i] in "\n;" or text[i] in ".!?" and i + 1 < len(text) and text[i + 1].isspace()
    end, joined = min(len(text), last + secrets.REACH), re.compile(r"[A-Za-z0-9+/_=.:~@-]")
    stop = next((i for i in range(last, len(text)) if ends(i)), len(text))
    end = max(end, stop)
    while 0 < end < len(text) and joined.match(text[end - 1]) and joined.match(text[end]):
        end += 1
    return end


def test_all_parts_of_a_joined_token():
    """header.payload.signature: the part that signs lies far behind the hint."""
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-") for _ in range(n)) for n in (36, 120, 43)]
    text = f"use my token {'.'.join(parts)} for the call"
    spans = secrets.novel_spans(text, text.lower(), [], secrets.primed())
    assert [text[a:b] for a, b, _ in spans] == parts


def test_price_against_compressing_twice():
    """The price is the size with the token less the size without it and its copies."""
    text = "the bearer Zk9xQ2vLr7TpWm4YbN8sHd3Jg6 and again Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    token = "Zk9xQ2vLr7TpWm4YbN8sHd3Jg6"
    c = secrets.primed()
    rest = text.replace(token, "", 1).replace(token, "")
    price = (len(c.compress(text.replace(" and again " + token, " and again ").encode())) - len(c.compress(rest.encode()))) / len(token)
    assert (price >= secrets.NOVELTY) == (len(secrets.novel_spans(text, text.lower(), [], c)) == 2)


def test_candidates_are_the_tokens_that_overlap_a_context():
    rng = random.Random(9)
    bits = ["webhook", "secret", "abcdefgh", "Xk9vQ2mL", " ", "  ", ".", "of it ", "=", "x" * 70, "-", "é"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        near = [(m.start() - secrets.REACH, reach(text, m.end())) for m in secrets.CONTEXT.finditer(text)]
        want = [m.span() for m in secrets.CANDIDATE.finditer(text) if any(m.start() < e and s < m.end() for s, e in near)]
        assert [(a, b) for a, b, _ in secrets.candidates(text)] == want
