"""The operators over odd tables: nulls, empty and very long texts, ties, repeats, no rows, clashing columns."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tidepool.llm import chat, decontaminate, exact, fuzzy_lines, line_hash, pieces, secrets, simhash, toxicity, warc
from tidepool.llm.components import connected_components

LONG = "word " * 60_000
#: (doc_id, text) and columns named like the operators' own
ROWS = [(1, "Alpha beta gamma. " * 6), (2, " Alpha  beta\tgamma. " * 6), (2, " Alpha  beta\tgamma. " * 6), (3, None), (None, None),
        (4, ""), (5, " \n\t"), (None, "Alpha beta gamma. " * 6), (6, LONG), (7, LONG + "x"), (8, "password = hunter2hunter2 é"),
        (-9, "Alpha beta gamma. " * 6 + "\n" + "one two three four five six seven eight nine ten eleven.")]
COLUMNS = "doc_id bigint, text string, id bigint, row string, fp int, text_hash string, score double, h int"
SMALL = [r for r in ROWS if len(r[1] or "") < 1000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "r", 2, "t", 0.5, 3) for r in ROWS], COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_groups(docs, none):
    got = exact.exact_groups(docs).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    sha = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}
    assert all(sha[r.text_sha256] == (r.keep_id, r.group_size) for r in got)
    assert sum(r.kept for r in got) == len(groups)
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact.exact_groups(none).count() == exact.drop_exact_copies(none).count() == 0


def test_long_texts_are_hashed_by_pieces(spark):
    body = "".join(chr(97 + k * k % 26) + ("é" if k % 97 == 0 else "") for k in range(2_500_000))
    spaced = " " * 700_000 + body[:900_000] + "\n\t" + body[900_000:]
    rows = [(5, body), (3, spaced), (3, spaced), (None, body), (7, body[:-1] + "!"), (8, "x")]
    got = sorted(((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact.exact_groups(
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()), key=str)
    sha = [hashlib.sha256(exact.normalised(t)).hexdigest() for t in (body, rows[4][1], "x")]
    assert got == sorted([(False, 5, 3, 4, sha[0]), (False, 3, 3, 4, sha[0]), (False, 3, 3, 4, sha[0]), (True, None, 3, 4, sha[0]),
                          (False, 7, 7, 1, sha[1]), (False, 8, 8, 1, sha[2])], key=str)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id AS id", "text", "xxhash64(text) AS text_hash")
    pairs = {r.key.id: (r.n_bytes, r.fp) for r in exact._long_pairs(docs).collect()}
    want = exact._pair(exact.normalised(body))
    assert pairs == {5: want, 3: want, None: want, 7: exact._pair(exact.normalised(rows[4][1]))}


def test_exact_groups_despite_equal_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(exact, "PRIME", 257)  # collisions are common; also where workers are forked from here
    rows = [(k, f"{k % 40:03d}") for k in range(400)]
    got = exact.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(k, k % 40, 10) for k in range(400)}


def test_pieces_of_a_document_combine(spark):
    data = [(1, k, bytes([65 + k]) * k) for k in range(9)] + [(2, 0, None), (None, 0, b"x")]
    got = exact.combine_pieces(spark.createDataFrame(data, "d bigint, k int, b binary"), "d", "k", "b").collect()
    want = {1: exact._pair(b"".join(b for _, _, b in data[:9])), 2: exact._pair(b""), None: exact._pair(b"x")}
    assert {r.d: (r.n_bytes, r.fp) for r in got} == want


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101), (7, 7), (None, 5), (101, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src bigint, dst bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_near_groups(docs, none):
    got = simhash.near_groups(docs).collect()
    assert len(got) == len(ROWS)
    fps = [(i, simhash.simhash(t) & (1 << 64) - 1) for i, t in ROWS]
    for r in got:
        near, grown = {int(r.fingerprint, 16)}, True
        while grown:
            more = {f for _, f in fps if any((f ^ x).bit_count() <= 4 for x in near)}
            grown, near = more - near, more
        assert r.component_id == min(i for i, f in fps if f in near and i is not None)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len({r.root for r in got})
    assert simhash.near_groups(none).count() == simhash.drop_near_copies(none).count() == 0


def test_dense_near_copies_lose_no_link(spark):
    base = 0x0123456789ABCDEF
    fps = {base ^ 1 << a ^ 1 << b for a in range(0, 62, 2) for b in range(1, 62, 3)} | {~base & (1 << 64) - 1}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"))
    found = connected_components(links).collect()
    assert len(found) == len(fps) - 1 and len({r.component for r in found}) == 1
    assert links.count() < 64 * len(fps)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Hunter2hunter2, é!"), (3, None), (4, "..."), (5, "gamma alpha"),
         (None, "alpha beta gamma alpha beta gamma alpha beta gamma alpha beta gamma"), (1, "beta gamma alpha")]


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _hits(text):
    w, hit, items = _words(text), set(), set()
    for item, t in ITEMS:
        q = _words(t)
        for s in range(max(1, len(q) - 9) if q else 0):
            win = q[s : s + 10]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    items.update([str(item)] if item is not None else [])
    return len(w), len(hit), ",".join(sorted(items))


@pytest.mark.parametrize("limit", (decontaminate.BROADCAST_BYTES, 0))
def test_decontamination(spark, docs, none, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    bench = spark.createDataFrame([(*r, 1, "w") for r in ITEMS], "item_id bigint, text string, w int, win string")
    got = decontaminate.report(decontaminate.scan(docs, bench)).collect()
    want = sorted((str(i), *_hits(t)) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in got) == [x[:3] for x in want]
    assert sorted((str(r.doc_id), r.items_sha256) for r in got) == sorted((x[0], hashlib.sha256(x[3].encode()).hexdigest()) for x in want)
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(i, t) for i, t in ROWS if not _hits(t)[1]}
    cut = decontaminate.cut_spans(docs, bench).select("doc_id", "text").collect()
    assert len(cut) == len(ROWS) and ("password = ",) in [(r.text,) for r in cut if r.doc_id == 8]
    assert decontaminate.scan(none, bench).count() == 0
    assert decontaminate.scan(docs, bench.limit(0)).where(F.size("hits") > 0).count() == 0


def test_secrets(docs, none):
    got = secrets.secret_spans(docs).collect()
    assert len(got) == len(ROWS) and {r.doc_id: r.base for r in got}[8] == "assign:0:25"
    assert {r.text for r in secrets.redact(docs).where("doc_id = 8").collect()} == {"[SECRET] é"}
    assert secrets.secret_spans(none).count() == 0


def test_repeated_spans(docs, none):
    got = line_hash.repeated_spans(docs, min_words=3).collect()
    texts = dict(ROWS)
    assert {r.doc_id for r in got} >= {1, 2} and all(re.match(r"Alpha|word", texts[r.doc_id][r.start :]) for r in got if r.doc_id)
    assert all(r.first_ids[0] == -9 for r in got if r.doc_id in (1, 2))
    left = {r.doc_id: r for r in line_hash.remove_repeats(docs, min_words=3).collect()}
    assert left[8].text == texts[8] and left[8].removed is None and norm(left[1].text) == "" and left[3].text is None
    assert len(left) < line_hash.remove_repeats(docs).count() == len(ROWS)
    assert line_hash.repeated_spans(none).count() == line_hash.remove_repeats(none).count() == 0


def test_passages_planted_within_sentences_are_found(spark):
    rnd = random.Random(5)
    count = itertools.count()  # no word comes twice but in a passage
    prose = lambda n: [f"{rnd.choice('bcdfgh')}{next(count)}" + rnd.choice(["", "", "", "", "", ",", "."]) for _ in range(n)]
    wrap = lambda words, k: "\n".join(" ".join(words[j : j + k]) for j in range(0, len(words), k))
    rows, planted = [], {}
    for k in range(60):
        passage, before = [w.upper() if k % 2 else w for w in prose(51 + k % 30)], prose(30 + k)
        rows.append((k, wrap(prose(40 + k) + passage + prose(35), 9 + k % 4)))
        rows.append((1000 + k, wrap(before + passage + prose(30), 13 + k % 5)))
        planted[1000 + k] = (len(before), len(before) + len(passage))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {}
    for r in line_hash.repeated_spans(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    left = {r.doc_id: r.text for r in line_hash.remove_repeats(docs).collect()}
    for d, t in rows:
        at = [m.span() for m in re.finditer(r"\w+", t)]
        hit = [any(a <= x and y <= b for a, b in spans.get(d, [])) for x, y in at]
        a, b = planted.get(d, (0, 0))
        assert sum(hit[a:b]) >= b - a - 2 * line_hash.STRIDE + 1 and not any(hit[:a] + hit[b:])
        assert len(re.findall(r"\w+", left[d])) == len(at) - sum(hit)


def test_short_lines_that_repeat_are_reported(spark):
    lines = {k: " ".join(f"w{k}x{j}" for j in range(k)) + "." for k in range(1, 25)}
    rows = [(100 * d + k, f"only {d} {k} here\n{lines[k]}") for d in (1, 2, 3) for k in lines]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_hash.repeated_spans(docs).collect()
    want = {i: (t.index("\n") + 1, len(t)) for i, t in rows if i > 200}
    spans = {(r.doc_id, r.start, r.end) for r in got}
    assert {(i, *w) for i, w in want.items()} <= spans and all(len("only 1 ") <= a and b <= want[i][1] for i, a, b in spans)  # pieces share "here", too
    left = {r.doc_id: r.text for r in line_hash.remove_repeats(docs, min_words=9).collect()}
    assert lines[8] in left[308] and lines[9] not in left[309]


def test_line_classes(spark, docs, none):
    got = fuzzy_lines.line_classes(docs).collect()
    assert len(got) == sum(len(fuzzy_lines.lines_of(t)) for _, t in ROWS)
    assert {(r.keep_id, r.keep_line_no) for r in got if r.doc_id in (1, 2)} == {(-9, 0)}
    assert {(r.doc_id, r.keep_id) for r in got if r.doc_id in (6, 7)} == {(6, 6), (7, 6)}
    assert fuzzy_lines.line_classes(none).count() == 0


def test_large_buckets_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 3)
    lines = [(k, "the quick brown fox jumps over the lazy dog again and again until night falls " * 3 + f"{k:02d}") for k in range(20)]
    got = fuzzy_lines.line_classes(spark.createDataFrame(lines, "doc_id bigint, text string")).collect()
    assert {(r.keep_id, r.kept) for r in got if r.doc_id} == {(0, False)} and len(got) == 20


TURNS = [(1, 0, "user", "hi"), (1, 1, "user", "again"), (1, 2, "bot", None), (2, 0, "assistant", "x"), (None, 0, None, None), (3, 0, "system", ""),
         (3, 0, "system", ""), (4, None, "user", "q"), (4, 1, "user", "a")]


def test_repaired_turns(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, part int, row int, h int"
    rows = [(*t, 1, 2, 3) for t in TURNS]
    many = [(9, k, ("user", "assistant", "x")[k % 3 if k % 7 else 0], str(k), 1, 2, 3) for k in range(600)]
    got = chat.repaired_turns(spark.createDataFrame(rows + many, schema).repartition(5)).collect()
    assert len(got) == len(rows + many)
    text = {}
    for r in sorted(got, key=lambda r: r.seq):
        text[r.conv_id] = text.get(r.conv_id, "") + r.piece
    assert text[1] == "<|im_start|>user\nhi\nagain<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    for whole in text.values():  # every rendered conversation is legal
        roles = re.findall(r"<\|im_start\|>(\w+)\n", whole)
        assert re.fullmatch(r"(system )?(user assistant )+", " ".join(roles) + " ") and whole.count("<|im_end|>\n") == len(roles)
    own = sorted((r for r in got if r.conv_id == 9), key=lambda r: r.seq)
    assert [r.seq for r in own] == list(range(600)) and [r.turn for r in own] == list(range(600))
    best = chat.repair([chat.role_of(m[2]) for m in many])
    cost = lambda steps: sum(len(f) * chat.INSERT + (a == "merge") * chat.MERGE for _, a, f in steps)
    named = [(chat.NAMES[r.new_role], r.action, tuple(chat.NAMES[x] for x in r.inserted)) for r in own]
    assert cost(named) + sum(chat.CHOICES[chat.role_of(m[2])][q, q][0] for m, (q, _, _) in zip(many, named)) >= 0
    total = lambda steps: _total([chat.role_of(m[2]) for m in many], steps)
    assert total(named) == total(best)
    assert chat.repaired_turns(spark.createDataFrame([], schema)).count() == 0


def _total(roles, steps):
    s, cost = chat.START, 0
    for r, (q, _, _) in zip(roles, steps):
        cost, s = cost + chat.CHOICES[r][s, q][0], q
    return cost + chat.end_cost(s)


def test_a_conversation_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = [(k % 2 and 9, k, ("user", "assistant", "x", None)[k * k % 7 % 4], str(k)) for k in range(900)] + [(9, 5, "user", "same")] * 200
        got = chat.repaired_turns(spark.createDataFrame(many, "conv_id bigint, turn bigint, role string, text string").repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv in (0, 9):
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.seq)
        roles = [chat.role_of(r.role) for r in own]
        assert [r.seq for r in own] == list(range(len(own)))
        assert _total(roles, [(chat.NAMES[r.new_role], 0, 0) for r in own]) == _total(roles, chat.repair(roles))


def test_encode_and_decode(docs, none):
    got = pieces.encode_documents(docs)
    assert got.where("round_trip").count() == len(ROWS)
    back = {(r.doc_id, r.text) for r in pieces.decode_documents(got).collect()}
    assert back == {(i, t or "") for i, t in ROWS}
    assert pieces.encode_documents(none).count() == 0


def test_all_segmentations_are_returned_and_decoded(docs):
    model = pieces.load()
    rows = pieces.encode_documents(docs).collect()
    for r in rows:
        cuts = [r.ids, *r.alternatives]
        assert len(cuts) == len(r.scores) and len({tuple(c) for c in cuts}) == len(cuts)
        assert [hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in c)).hexdigest() for c in cuts] == r.ids_sha256
        assert r.round_trip and len({pieces.decode(c, model) for c in cuts}) == 1
    assert max(len(r.alternatives) for r in rows) == pieces.BEST - 1


def test_segmentations_decode_alike_as_their_texts_are_equal():
    import numpy as np

    model, rng = pieces.load(), random.Random(5)
    some = [pieces.segment([t], model)[0] for t in ("aaa aaa", "aaa  aab", "é\n\nx", "ab", "")]
    cuts = [ids.view("<i4") for found in some for _, ids in found]
    few = [int(i) for c in cuts for i in c] + [int(i) for i in model.byte_ids[[0xC3, 0xA9, 0x80, 0xFF]]]
    cuts += [np.array(rng.choices(few, k=rng.randrange(5)), "<i4") for _ in range(60)]
    for a, b in itertools.product(cuts, cuts):
        assert pieces.decode_alike(a, b, model) == (pieces.decode(a, model) == pieces.decode(b, model))


def test_one_wrong_segmentation_is_no_round_trip(spark, monkeypatch):
    segment = pieces.segment
    monkeypatch.setattr(pieces, "segment", lambda texts, model, n: [[*best[:-1], (best[-1][0], best[-1][1][:-1])] for best in segment(texts, model, n)])
    row = pieces.encode_documents(spark.createDataFrame([(1, "Alpha beta gamma.")], "doc_id bigint, text string")).first()
    assert row.round_trip is False and pieces.decode(row.ids, pieces.load()) == "Alpha beta gamma."


def test_toxicity_sample_holds_one_text_an_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {k:04d}") for k in range(2000)] + [(2, None), (2, "b")], "doc_id bigint, text string")
    held = docs.select(toxicity.fold_of("doc_id").alias("f"), "doc_id").where("f = 1").select("doc_id").distinct()
    labels = spark.createDataFrame([(k, 0) for k in (1, 2) if k not in {r.doc_id for r in held.collect()}], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda rows: rows)
    got = toxicity.train(docs, labels)
    assert sorted(got) == sorted([("text 0000", 0), ("b", 0)][k - 1] for k in [r.doc_id for r in labels.collect()])


def test_toxicity_tables(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (6, None), (6, 1), (6, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert toxicity.drop_toxic(docs, docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.toxicity(none, toxicity.train(none, labels)).count() == 0
    assert toxicity.drop_toxic(none, docs, labels).columns == docs.columns


def test_archives(spark, tmp_path):
    big = "<p>é</p>" * 40
    rows = [(3, "http://a/ b", big), (1, "http://a", big), (2, None, big), (4, "http://b", "small"), (5, "http://b", "small"), (6, "", None),
            (None, "http://c", big), (7, "http://d", "\r\n\r\nWARC/1.1\r\n" + big), (3, "http://a/ b", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, value int").repartition(3)
    warc.write_arc(pages, str(tmp_path / "arc"))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    records = warc.read_warc(spark, str(tmp_path / "warc")).cache()
    assert records.where("NOT intact").count() == 0 and records.select("record_id").distinct().count() == len(rows)
    got = sorted((str(r.own), r.n, r.digest, r.type, r.to_own) for r in warc.resolved(records).collect())
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        copy = body == big.encode() and i != 1
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if copy else "response", 1 if copy else None))
    assert got == sorted(want, key=lambda x: x[:4])
