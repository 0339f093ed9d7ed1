"""The operators' row-level parts against brute force and fixed cases, without Spark."""

import base64
import gzip
import itertools
import json
import random

import numpy as np
import pytest

from tidepool.llm import chat, exact, fuzzy_lines, line_hash, pieces, secrets, simhash, toxicity, warc


# exact dedup -------------------------------------------------------------------------------------------

def test_fingerprints_compose_at_any_cut():
    data = bytes(random.Random(1).randrange(256) for _ in range(5000))
    whole = exact.fingerprint(data)
    for cut in (0, 1, 77, 4999, 5000):
        assert exact.combine(exact.fingerprint(data[:cut]), exact.fingerprint(data[cut:])) == whole
    assert exact.fingerprint(data, chunk=7) == whole
    assert exact.fingerprint(b"") == (0, 0)
    assert exact.fingerprint(b"\0a") != exact.fingerprint(b"a")


# simhash -----------------------------------------------------------------------------------------------

def test_segments_leave_one_bit_at_most():
    for distance in (2, 3, 4, 6):
        cut = simhash.segments(distance)
        assert sum(n for _, n in cut) == 64 and 2 * len(cut) > distance


def test_link_run_joins_what_brute_force_joins():
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = {b for x in base for _ in range(40) for b in [x ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(5)))]}
    fps = sorted(x & (1 << 64) - 1 for x in fps)
    links = simhash.link_run(np.array(fps, np.uint64), 4)
    assert len(links) < len(fps)
    assert _classes(fps, [(int(a), int(b)) for a, b in links]) == _classes(
        fps, [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 4])


def _classes(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def test_simhash_of_odd_texts():
    assert simhash.simhash(None) == simhash.simhash(" \t\n\x0b\x0c\r ") == 0
    assert simhash.simhash("A b") == simhash.simhash("a\tB")
    assert simhash.simhash("\x1ca") != simhash.simhash("a")  # not white space here
    assert simhash.simhash("É") != simhash.simhash("é")  # only A-Z are lower-cased


# secrets -----------------------------------------------------------------------------------------------

def _der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


RSA = _der(0x30, _der(2, b"\0") + b"".join(_der(2, bytes([65 + k]) * 40) for k in range(8)))


def test_keys_parse_only_if_lengths_nest():
    assert secrets.is_der_key(RSA)
    assert not secrets.is_der_key(RSA[:-1]) and not secrets.is_der_key(RSA + b"x")
    broken = bytearray(RSA)
    broken[8] += 1  # a length
    assert not secrets.is_der_key(bytes(broken))
    assert not secrets.is_der_key(b"")


def test_confirmed_kinds():
    url = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    good = f"{url({'alg': 'HS256'})}.{url({'sub': 1})}.c2lnbg"
    bad = f"{url({'typ': 'x'})}.{url({'sub': 1})}.c2lnbg"
    body = base64.b64encode(RSA).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body[:64]}\n{body[64:]}\n-----END RSA PRIVATE KEY-----"
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(b"pub") + field(b"priv")
    for text, kinds in ((good, {"token"}), (bad, set()), (pem, {"pem"}), (body, {"der"}), (RSA.hex(), {"der"}),
                        (base64.b64encode(ssh).decode(), {"openssh"}), ("A" * 60, set()), ("", set())):
        spans = secrets.confirmed_spans("é " + text + " x")
        assert {secrets.KINDS[k] for _, k, _ in spans} >= kinds and bool(spans) == bool(kinds), text[:40]


def test_base_spans():
    assert secrets.base_spans("secret=token:abcdefgh") == []  # the failing match still uses up its text
    assert secrets.base_spans("API_KEY: 'abcdef'") == [(0, 0, 16)]
    assert secrets.base_spans("paſſword=abcdef") == []  # letters in either case, of ASCII
    assert secrets.base_spans("x" + "AKIA" + "A" * 15) == [] and secrets.base_spans("AKIA" + "A" * 16) == [(0, 1, 20)]
    assert secrets.base_spans("é" + "0" * 24) == [(1, 2, 25)]


# lines -------------------------------------------------------------------------------------------------

def test_units_of_a_text():
    text = "  One two. Three, FOUR!  \n\n...\nfive\n- six É"
    spans = lambda t, every=True: [(t[a:b], n) for _, a, b, n, *_ in zip(*(line_hash.cut(t, every) or ([],) * 6))]
    whole = [("One two. Three, FOUR!  ", 4), ("five", 1), ("- six É", 2), ("...\nfive\n- six É", 3)]
    assert spans(text, False) == whole
    assert spans(text) == whole + [("One two.", 2), ("Three, FOUR!", 2)]
    assert line_hash.cut(None) is None and line_hash.cut("...\n") is None
    digest = lambda t: list(zip(*line_hash.cut(t)[4:]))
    assert digest("Foo bar baz. Qux quux")[0] == digest("foo bar baz, qux quux!")[0] == digest("x\n\nFOO bar\nbaz qux quux")[3]
    assert digest("one two")[0] != digest("onet wo")[0] != digest("two one")[0] and digest("a a")[0] != digest("a")[0]


def test_digests_do_not_depend_on_the_surroundings():
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 9))) for _ in range(400)]
    for _ in range(20):
        line = " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))
        alone = line_hash.cut(line, False)
        among = line_hash.cut("\n\n".join(["x " * rnd.randrange(1, 9000), line, "y"]), False)
        assert (alone[4][0], alone[5][0]) == (among[4][1], among[5][1])


def test_band_recall_and_exact_links():
    rnd = random.Random(2)
    hits = 0
    for _ in range(200):
        a = "".join(rnd.choice("abcdefgh ") for _ in range(300))
        b = a[:150] + "XYZ" + a[150:]
        keys = fuzzy_lines.band_keys([a, b])
        hits += bool((keys[0] == keys[1]).any())
    assert hits >= 199
    lines = [(1, "abcdefghijklmnopqrstuvwxyz" * 3 + "0"), (2, "abcdefghijklmnopqrstuvwxyz" * 3 + "1"), (3, "nothing like them at all")]
    assert fuzzy_lines.link_lines(lines, 0.8) == [(1, 2)]
    assert fuzzy_lines.band_keys(["x"]).shape == (1, fuzzy_lines.BANDS)


def test_lines_are_taken_apart_only_where_white_space_has_to_go(monkeypatch):
    rnd = random.Random(3)
    odd = "aB \n\t\r\x1c\x85\xa0\u1680\u2003\u2019\u2028\u205f\u3000\u0130\u03a3\u00e9"
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randrange(14))) for _ in range(3000)] + [f"a{c}b {c}" for c in odd]
    for t in texts:
        assert [n for _, _, n in fuzzy_lines.lines_of(t)] == [n for n in (" ".join(x.lower().split()) for x in t.split("\n")) if n]
        assert all(" ".join(t[a:b].lower().split()) == n for a, b, n in fuzzy_lines.lines_of(t))
    calls = []
    monkeypatch.setattr(fuzzy_lines, "normalised", lambda line: calls.append(line) or " ".join(line.lower().split()))
    plain = "One line\nanother \u2019LINE\u2019\n\n"
    assert [n for _, _, n in fuzzy_lines.lines_of(plain)] == ["one line", "another \u2019line\u2019"] and not calls
    assert [n for _, _, n in fuzzy_lines.lines_of(" x\ny  z\nv w")] == ["x", "y z", "v w"] and calls == [" x", "y  z"]


def test_lines_that_buckets_share_are_hashed_and_linked_once(monkeypatch):
    near = {k: "abcdefghijklmnopqrstuvwxyz" * 3 + str(k) for k in range(6)}
    far = {k: str(k) * 9 + "".join(random.Random(k).choice("abcdefgh ") for _ in range(200)) for k in range(6, 20)}
    rows = [(0, 0, 0, key, i, norm) for key in range(4) for i, norm in (near | far).items() if i < 2 or (i + key) % 3]
    hashed, sets = [], fuzzy_lines.shingle_sets
    monkeypatch.setattr(fuzzy_lines, "shingle_sets", lambda lines: hashed.extend(lines) or sets(lines))
    links = [*fuzzy_lines._compared(0.8)(iter(rows))]
    assert sorted(hashed) == sorted({r[5] for r in rows}) and len(links) == 5
    assert set(_classes(near, links).values()) == {0} and {i for link in links for i in link} == set(near)


# chat --------------------------------------------------------------------------------------------------

def _brute(roles):
    """Least cost over every way to deal with every turn."""
    best = chat.INF
    for states in itertools.product(range(1, 4), repeat=len(roles)):
        cost, s = 0, chat.START
        for r, q in zip(roles, states):
            way = chat.CHOICES[r].get((s, q))
            cost, s = (cost + way[0], q) if way else (chat.INF, q)
        best = min(best, cost + (chat.end_cost(s) if roles else 0))
    return best


def _cost(roles, steps):
    s, cost = chat.START, 0
    for r, (q, action, fill) in zip(roles, steps):
        assert chat.CHOICES[r][s, q][1:] == (action, fill)
        cost, s = cost + chat.CHOICES[r][s, q][0], q
    return cost + chat.end_cost(s)


@pytest.mark.parametrize("seed", range(30))
def test_repair_is_cheapest_whole_or_in_stretches(seed):
    rnd = random.Random(seed)
    roles = [rnd.choice((None, 1, 2, 3)) for _ in range(rnd.randint(1, 7))]
    assert _cost(roles, chat.repair(roles)) == _brute(roles)
    cut = rnd.randint(1, len(roles))
    parts = [p for p in (roles[:cut], roles[cut:]) if p]
    states = chat.settle([chat.table_of(p) for p in parts])
    steps = sum((chat.repair(p, a, b) for p, a, b in zip(parts, states, states[1:])), [])
    assert _cost(roles, steps) == _brute(roles)


# pieces ------------------------------------------------------------------------------------------------

def test_n_best_is_brute_force():
    m = pieces.load()
    rnd = random.Random(3)

    def every(s):
        out = []

        def go(i, score, ids):
            if i == len(s):
                out.append((score, ids))
            for j in range(i + 1, len(s) + 1):
                if hit := m.usable.get(s[i:j]):
                    go(j, score + hit[1], ids + (hit[0],))
                elif j == i + 1:
                    go(j, score + m.unknown, ids + tuple(int(m.byte_ids[b]) for b in s[i].encode()))

        go(0, 0.0, ())
        return sorted(out, key=lambda x: -x[0])

    for _ in range(150):
        s = "".join(rnd.choice(["the", "in", "a", "o", "é", " ", "  ", "\n", "😀", "ing", "er", "x"]) for _ in range(rnd.randint(1, 5)))
        want = every(pieces.marked(s))
        empty, got, none = pieces.segment(["", s, None], m)
        assert [x for x, _ in got] == [x for x, _ in want[:4]]
        scores = {ids: x for x, ids in want}
        assert all(scores[tuple(ids.tolist())] == x for x, ids in got) and len({tuple(i.tolist()) for _, i in got}) == len(got)
        assert len(empty[0][1]) == len(none[0][1]) == 0
        assert pieces.decode(got[0][1].tolist(), m) == s


def test_long_part_without_spaces():
    m = pieces.load()
    text = "abcdefghij" * 300
    (got,) = pieces.segment([text], m)
    assert len(got) == 4 and got[0][0] >= got[1][0] >= got[2][0]
    assert pieces.decode(got[0][1].tolist(), m) == pieces.decode(got[3][1].tolist(), m) == text


@pytest.mark.parametrize("text", ("aaa1" * 50, ".....x" * 34, "#" * 1003, "-" * 20000))
def test_paths_that_tie_are_not_all_opened(text, monkeypatch):
    m = pieces.load()
    pops, pop = [0], pieces.heapq.heappop

    def counted(queue):
        pops[0] += 1
        assert pops[0] <= 100 * (len(text) + 1) * pieces.BEST  # else it would not end
        return pop(queue)

    monkeypatch.setattr(pieces.heapq, "heappop", counted)
    (got,) = pieces.segment([text], m)
    assert len(got) == pieces.BEST == len({ids.tobytes() for _, ids in got})
    shown = pieces.marked(text)
    tops = [[0.0]] + [[] for _ in shown]  # the n best sums by place, plainly
    for j in range(1, len(tops)):
        sums = [x + m.usable[shown[i:j]][1] for i in range(max(0, j - m.longest), j) if shown[i:j] in m.usable for x in tops[i]]
        tops[j] = sorted(sums, reverse=True)[: pieces.BEST]
    assert [s for s, _ in got] == tops[-1]
    assert all(sum(m.usable[m.names[i]][1] for i in ids.tolist()) == s and pieces.decode(ids.tolist(), m) == text for s, ids in got)


# toxicity ----------------------------------------------------------------------------------------------

def test_toxicity_learns_marks_and_holds_on_odd_texts():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    prose = lambda bad: " ".join(rnd.choice(words) if not bad or rnd.random() > 0.1 else rnd.choice(["zibblequorg", "wickjax"]) for _ in range(150))
    rows = [(prose(k % 3 == 0), int(k % 3 == 0)) for k in range(300)]
    model = toxicity.fit(rows)
    fresh = [(prose(k % 2), k % 2) for k in range(60)]
    assert sum((toxicity.score(t, model) >= toxicity.THRESHOLD) == bool(y) for t, y in fresh) >= 57
    assert 0 <= toxicity.score(None, model) < 0.7 and 0 <= toxicity.score("x" * 300_000, model) <= 1
    assert toxicity.score("any", toxicity.fit([("a", 0)])) == 0.0 and toxicity.fit([]).toxic == b""
    assert b"".join(w[: toxicity.STEP] for w in toxicity.windows(b"0123456789" * 100)).startswith(b"0123456789" * 80)


# archives ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("zipped", (False, True))
@pytest.mark.parametrize("version", (1, 2))
def test_arc_versions(version, zipped):
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\n\n\nhttp://x 1 2 3 4\n"
    extra = b" 200 - - 0 f" if version == 2 else b""
    block = f"{version} 0 me\nfields\n\n".encode()
    data = [b"filedesc://f 0.0.0.0 20010101000000 text/plain" + extra + b" %d\n" % len(block) + block,
            b"\nhttp://h/a b 1.2.3.4 2001 text/html" + extra + b" %d\n" % len(body) + body, b"\ndns:h 1.2.3.4 20010203 -" + extra + b" 0\n"]
    content = b"".join(gzip.compress(d) for d in data) if zipped else b"".join(data)
    (_, first, _), (at, second, got), (_, third, _) = warc.arc_records(content)
    assert second["url"] == "http://h/a b" and got == body
    one, two, three = (warc.synthesise(f, b, o) for f, b, o in ((first, block, 0), (second, got, at), (third, b"", 0)))
    assert (one["type"], two["type"], three["type"]) == ("warcinfo", "response", "resource")
    assert two["date"] == "2001-01-01T00:00:00Z" and three["date"] == "2001-02-03T00:00:00Z" and three["media"] == "text/dns"
    assert two["body"] == b"\n\nhttp://x 1 2 3 4\n" and two["head"] + two["body"] == body
    assert two["record_id"] != one["record_id"]


def test_arc_that_lies_is_refused():
    with pytest.raises(ValueError):
        list(warc.arc_records(b"http://h 1.2.3.4 20010101000000 text/html 10\nshort"))
    with pytest.raises(ValueError):
        list(warc.arc_records(b"no header\n"))
