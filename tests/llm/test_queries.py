"""The registered queries whose results SQL cannot give, against brute force over the whole of sf0.001."""

import hashlib
import itertools
import re

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tidepool.llm import chat, fuzzy_lines, line_hash, pieces, simhash, toxicity

QUERIES = E.queries()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark, smoke_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}


def _classes(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_op2(spark, smoke_dir, texts):
    got = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, smoke_dir).collect()}
    assert set(got) == set(texts)
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                    ("password", "passwd", "secret", "token", "api_?key"))
    kinds = {"assign": rf"({word})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    for i, text in texts.items():
        spans = []
        for k, (kind, pattern) in enumerate(kinds.items()):
            for m in re.finditer(pattern, text):
                if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                    spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        base = [s for _, _, s in sorted(spans)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s.startswith(k) for s in base) for k in kinds]
        assert set(base) <= set(got[i].spans.split(",")) | {""}


def _units(text):
    """Lines, paragraphs of several lines, sentences of lines that have some: (start, end, words), by patterns."""
    words = lambda a, b: tuple(re.findall(r"\w+", text[a:b].lower()))
    trim = lambda a, b: a + len(text[a:b]) - len(text[a:b].lstrip())
    lines = [(trim(*m.span()), m.end(), words(*m.span())) for m in re.finditer(r"[^\n]+", text)]
    lines = [x for x in lines if x[2]]
    paragraphs = []
    for m in re.finditer(r"(?:[^\n]*\S[^\n]*(?:\n|\Z))+", text):
        end = m.end() - text[m.start() : m.end()].endswith("\n")
        if sum(m.start() <= a < end for a, _, _ in lines) > 1:
            paragraphs.append((trim(m.start(), end), end, words(m.start(), end)))
    sentences = []
    for a, b, own in lines:
        cuts = [a, *(m.end() for m in re.finditer(r"[.!?](?=\s)", text[: b + 1]) if a < m.end() < b), b]
        parts = [(trim(x, y), y, words(x, y)) for x, y in zip(cuts, cuts[1:])]
        sentences += [x for x in parts if x[2] and x[2] != own]
    return lines, paragraphs, sentences


def test_op3(spark, smoke_dir, texts):
    """Lines, paragraphs and sentences by another cutter; what else is reported stands, word for word, in an earlier place."""
    got = [(r.doc_id, r.start, r.end, r.n_words) for r in QUERIES["op3_substring_dedup"](spark, smoke_dir).collect()]
    cut = {i: _units(t) for i, t in texts.items()}
    first = {}
    for i in sorted(texts):
        for kind in cut[i]:
            for a, _, words in kind:
                first[words] = min(first.get(words, (i, a)), (i, a))
    want = set()
    for i in texts:
        for kind in cut[i]:
            run = []
            for a, b, words in [*kind, (0, 0, None)]:
                if words is not None and first[words] != (i, a):
                    run.append((a, b, len(words)))
                elif run:
                    want.add((i, run[0][0], run[-1][1], sum(n for _, _, n in run)))
                    run = []
    assert want and want <= set(got)
    joined = {i: " " + " ".join(re.findall(r"\w+", t.lower())) + " " for i, t in texts.items()}
    for i, a, b, n in set(got) - want:
        words = re.findall(r"\w+", texts[i][a:b].lower())
        assert len(words) == n
        for k in range(0, len(words), 3):  # pieces come from one or more earlier places
            part = " " + " ".join(words[k : k + 3]) + " "
            assert joined[i].count(part) > 1 or any(part in joined[j] for j in texts if j < i)


def test_op5(spark, smoke_dir):
    turns = spark.read.parquet(f"{smoke_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    got = {(r.conv_id, r.turn): r for r in QUERIES["op5_chat_role_repair"](spark, smoke_dir).collect()}
    assert len(got) == len(turns)
    for conv, own in itertools.groupby(turns, lambda r: r.conv_id):
        own = list(own)
        for seq, (t, (role, action, fill)) in enumerate(zip(own, chat.repair([chat.role_of(t.role) for t in own]))):
            r = got[conv, t.turn]
            assert (r.seq, r.new_role, r.action, tuple(r.inserted)) == (seq, chat.ROLES[role - 1], action, tuple(chat.ROLES[f - 1] for f in fill))
            assert t.text in r.piece


def _fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _near(texts):
    fps = {i: _fingerprint(t) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (fps[a] ^ fps[b]).bit_count() <= 4]
    return fps, _classes(fps, links)


def test_op7(spark, smoke_dir, texts):
    fps, classes = _near(texts)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_near_dedup"](spark, smoke_dir).collect()}
    assert got == {i: (f"{fps[i]:016x}", classes[i]) for i in texts}
    assert all(simhash.simhash(t) & (1 << 64) - 1 == fps[i] for i, t in texts.items())


def test_op8(spark, smoke_dir, texts):
    first, places = {}, {}
    for i in sorted(texts):
        for k, (_, _, norm) in enumerate(fuzzy_lines.lines_of(texts[i])):
            first.setdefault(norm, (i, k))
            places[i, k] = norm
    sets = {n: {n[j : j + 7] for j in range(max(1, len(n) - 6))} for n in first}
    order = sorted(sets, key=lambda n: len(sets[n]))
    links = []
    for x, a in enumerate(order):
        for b in order[x + 1 :]:
            if len(sets[a]) < 0.8 * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    classes, keep = _classes(order, links), {}
    for n, c in classes.items():
        keep[c] = min(keep.get(c, first[n]), first[n])
    got = {(r.doc_id, r.line_no): (r.keep_id, r.keep_line_no, r.kept) for r in QUERIES["op8_fuzzy_line_dedup"](spark, smoke_dir).collect()}
    assert got == {p: (*keep[classes[n]], keep[classes[n]] == p) for p, n in places.items()}


def test_op6(spark, smoke_dir, texts):
    import zlib

    docs, labels = (spark.read.parquet(f"{smoke_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, smoke_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].score == pytest.approx(toxicity.score(t, model)) and got[i].predicted == (got[i].score >= 0.7)


def test_op9(spark, smoke_dir, texts):
    model = pieces.load()
    for r in QUERIES["op9_sentencepiece_nbest"](spark, smoke_dir).collect():
        t = texts[r.doc_id]
        assert r.round_trip and pieces.decode(r.ids, model) == t and r.n_tokens == len(r.ids)
        assert r.scores[0] == r.score and r.scores == sorted(r.scores, reverse=True) and len(set(r.ids_sha256)) == len(r.scores)
        assert len(r.scores) == pieces.BEST or len(t) < 10


def test_pipeline(spark, smoke_dir, texts):
    docs, labels = (spark.read.parquet(f"{smoke_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    kept = {i: t for i, t in texts.items() if toxicity.score(t, model) < 0.7}
    norm = {}
    for i in sorted(kept, key=lambda i: (-len(kept[i]), i)):
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]", "", kept[i]), i)
    kept = {i: kept[i] for i in norm.values()}
    _, classes = _near(kept)
    kept = {i: t for i, t in kept.items() if classes[i] == i}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    wins = set()
    for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect():
        w = words(r.text or "")
        wins |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in wins}

    def clean(t):
        w = words(t)
        return not any(tuple(w[k : k + n]) in wins for n in sizes for k in range(len(w) - n + 1))

    kept = {i: t for i, t in kept.items() if clean(t)}
    got = {r.doc_id: r.n_tokens for r in QUERIES["pipeline"](spark, smoke_dir).collect()}
    ids = sorted(kept)
    assert got == {i: len(s[0][1]) for i, s in zip(ids, pieces.segment([kept[i] for i in ids], pieces.load()))}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "sentencepiece"]
