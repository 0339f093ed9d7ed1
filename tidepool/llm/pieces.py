"""N-best segmentation into the pieces of a SentencePiece model, and decoding.

A forward Viterbi pass over the lattice of pieces gives, for every place in the text, the best score with which
it can be reached. That is an exact heuristic for an A-star search from the end backwards: paths leave its
queue in order of their full score, so the first n to arrive are the n best. No piece of the model runs from a
letter into a space mark, so a text's lattice falls apart at the spaces: its parts are searched apart (and the
commonest remembered), and the n best of the whole text are the n cheapest choices of their alternatives.

The model's file is read on the driver; its table of pieces travels with the tasks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import query
from .common import map_rows, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 50_000  # parts whose alternatives a task remembers; others are searched again
LONG = 100  # characters of a part up to which parts are passed over together
AT_ONCE = 1 << 18  # characters of texts that are passed over together (a longer text goes alone)


@dataclass(frozen=True)
class Pieces:
    """What a model says, and its pieces as a trie in arrays: child of state s by character class c is slot
    base[s] + c if owner says s there; piece and score hold what ends in a slot (-1: nothing)."""

    names: list[str]
    usable: dict[str, tuple[int, float]]  # pieces that text may be cut into: id, score
    byte_ids: np.ndarray
    unknown: float  # score of a character that is no piece
    longest: int
    classes: np.ndarray  # by code point; 0: in no piece
    base: np.ndarray
    owner: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    memory: dict = field(default_factory=dict, compare=False)


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.vocab_size()
    names = [m.id_to_piece(i) for i in range(n)]
    usable = {names[i]: (i, float(m.get_score(i))) for i in range(n)
              if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
    if any(SPACE in p.lstrip(SPACE) for p in usable):
        raise ValueError("a piece of this model runs across a space")
    found = {names[i]: i for i in range(n) if m.is_byte(i)}
    byte_ids = np.array([found.get(f"<0x{b:02X}>", m.unk_id()) for b in range(256)])
    unknown = min(s for _, s in usable.values()) - UNKNOWN_PENALTY
    return Pieces(names, usable, byte_ids, unknown, max(map(len, usable)), *_trie(usable))


def _trie(usable: dict[str, tuple[int, float]]) -> tuple[np.ndarray, ...]:
    common = Counter(c for p in usable for c in p)
    classes = np.zeros(0x110000, np.int32)
    for k, (c, _) in enumerate(common.most_common(), 1):
        classes[ord(c)] = k
    root: dict = {}
    for p in usable:
        node = root
        for c in p:
            node = node.setdefault(int(classes[ord(c)]), {})
    nodes, size = [root], len(common) + 1
    for node in nodes:  # grows meanwhile
        nodes.extend(node.values())
    slots = 4 * len(nodes) + 2 * size
    base, owner = np.zeros(slots, np.int32), np.full(slots, -1, np.int32)
    free, low = np.ones(slots, bool), 1
    for node in sorted((x for x in nodes if len(x) > 1), key=len, reverse=True):
        own, at, wide = np.fromiter(node, np.int64), low, 64
        while True:  # the first place where all children's slots are free
            tries = np.arange(at, at + wide)
            fits = free[tries[:, None] + own].all(axis=1)
            if fits.any():
                at = int(tries[fits.argmax()])
                break
            at, wide = at + wide, 2048
        free[at + own] = False
        node[0] = at  # class 0 is no character's
        if at > low + 4096:  # what is free below is not worth another search
            low = at - 2048
    open_slots = iter((np.flatnonzero(free[size + 1 :]) + size + 1).tolist())
    for node in nodes:
        if len(node) == 1 and 0 not in node:
            node[0] = next(open_slots) - next(iter(node))
    # number the states from the root down, now that every node has its place
    todo = [(root, 0)]
    for node, s in todo:
        if 0 in node:
            base[s] = node[0]
            for c, child in node.items():
                if c:
                    owner[node[0] + c] = s
                    todo.append((child, node[0] + c))
    piece, score = np.full(slots, -1, np.int32), np.zeros(slots)
    for p, (i, value) in usable.items():
        s = 0
        for c in p:
            s = base[s] + classes[ord(c)]
        piece[s], score[s] = i, value
    return classes, base, owner, piece, score


def search(part: str, model: Pieces, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best (score, ids) of one part, best first, by A-star from its end; fewer if there are not n.

    No place is opened more than n times, so time and queue grow with the part's length even where all paths tie.
    """
    size, usable, longest = len(part), model.usable, model.longest
    into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]  # (start, score, ids) by end
    reach = [0.0] + [float("-inf")] * size
    for i in range(size):
        for j in range(i + 1, min(size, i + longest) + 1):
            if hit := usable.get(part[i:j]):
                into[j].append((i, hit[1], (hit[0],)))
                reach[j] = max(reach[j], reach[i] + hit[1])
            elif j == i + 1:  # a character that is no piece, as bytes
                ids = tuple(int(model.byte_ids[b]) for b in part[i].encode("utf-8", "surrogatepass"))
                into[j].append((i, model.unknown, ids))
                reach[j] = max(reach[j], reach[i] + model.unknown)
    found, met, opened = [], 0, [0] * (size + 1)
    # bound, place, order, score from here on, path from here on: of equal bounds the one nearest to its start goes on,
    # so that a path is finished before its equals are opened; a place's first n arrivals are all that the n best need
    queue = [(-reach[size], size, 0, 0.0, None)]
    while queue and len(found) < n:
        bound, place, _, done, path = heapq.heappop(queue)
        if place == 0:
            ids = []
            while path:
                ids.extend(path[0])
                path = path[1]
            found.append((-bound, tuple(ids)))
            continue
        if opened[place] == n:
            continue
        opened[place] += 1
        for i, s, own in into[place]:
            met += 1
            heapq.heappush(queue, (-(reach[i] + s + done), i, -met, s + done, (own, path)))
    return found


def marked(text: str) -> str:
    """The text as the model sees it: a space before it, spaces as marks. An empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def forward(texts: list[str], model: Pieces) -> tuple:
    """The Viterbi pass over all parts of some marked texts at once, in arrays.

    Gives the characters, the parts' places, best score and what the second best loses by part, and by place
    the id of the piece that starts there on the best path (-1: none; below: a character as bytes).
    """
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    size, mark = len(chars), ord(SPACE)
    new = np.zeros(size, bool)
    new[0] = True
    new[1:] = (chars[1:] == mark) & (chars[:-1] != mark)
    ends = np.cumsum([len(t) for t in texts])
    new[ends[ends < size]] = True  # the first character of a text; empty texts have none
    first = np.flatnonzero(new)
    part = np.cumsum(new) - 1
    last = np.concatenate((first[1:], [size]))
    left = (last[part] - np.arange(size)).astype(np.int32)  # characters to the end of the part
    rel = np.arange(size) - first[part]
    node = np.arange(size) + part  # a part of k characters has k + 1 nodes
    stop = last + np.arange(len(first))

    b1, b2 = np.full(size + len(first), -np.inf), np.full(size + len(first), -np.inf)
    b1[first + np.arange(len(first))] = 0
    back, by = np.zeros(len(b1), np.int32), np.full(len(b1), -1, np.int64)
    long = (last - first) > LONG
    active = np.flatnonzero(~long[part])
    classes = model.classes[chars]
    state = np.zeros(len(active), np.int32)
    edges = []  # of each length: places sorted by rel, pieces, scores, where each rel begins
    for k in range(1, model.longest + 1):
        c = classes[active + (k - 1)]
        to = model.base[state] + c
        ok = (model.owner[to] == state) & (c > 0)
        if k == 1:
            none = active[~ok | (model.piece[to] < 0)]
            ids = np.where(chars[none] < 128, model.byte_ids[chars[none] & 127], -2 - chars[none])
            odd = (none, ids, np.full(len(none), model.unknown))
        active, state = active[ok], to[ok]
        hit = model.piece[state] >= 0
        at, ids, scores = active[hit], model.piece[state[hit]], model.score[state[hit]]
        if k == 1:
            at, ids, scores = (np.concatenate(x) for x in zip((at, ids, scores), odd))
        order = np.argsort(rel[at].astype(np.uint8), kind="stable")
        at, ids, scores = at[order], ids[order], scores[order]
        edges.append((node[at], ids, scores, np.searchsorted(rel[at], np.arange(LONG + 1))))
        more = left[active] > k
        active, state = active[more], state[more]
    for r in range(int(rel[~long[part]].max(initial=-1)) + 1):
        for k, (at, ids, scores, begins) in enumerate(edges, 1):
            a, b = begins[r], begins[r + 1]
            if a == b:
                continue
            start, w = at[a:b], scores[a:b]
            end = start + k
            c1, old = b1[start] + w, b1[end]
            better = c1 > old
            b2[end] = np.maximum(np.maximum(b2[end], b2[start] + w), np.minimum(old, c1))
            b1[end] = np.where(better, c1, old)
            win = end[better]
            back[win], by[win] = k, ids[a:b][better]
    token = np.full(size, -1, np.int64)
    cur, own = stop[~long], np.flatnonzero(~long)
    while len(cur):
        step, ids = back[cur], by[cur]
        cur = cur - step
        token[cur - own] = ids
        on = cur > (first + np.arange(len(first)))[own]
        cur, own = cur[on], own[on]
    best, loss = b1[stop], np.zeros(len(first))
    loss[~long] = best[~long] - b2[stop[~long]]
    for p in np.flatnonzero(long):  # long parts one by one; their ids are kept apart
        two = search("".join(map(chr, chars[first[p] : last[p]])), model, 2)
        best[p], loss[p] = two[0][0], two[0][0] - two[1][0] if len(two) > 1 else np.inf
        token[first[p]] = -2_000_000 - p
        model.memory[("long", int(p))] = two[0][1]
    return chars, first, last, best, loss, token


def _ids(token: np.ndarray, model: Pieces) -> np.ndarray:
    """Ids of the pieces that start at these places; marks of bytes and of long parts filled in."""
    ids = token[token != -1]
    if (ids >= 0).all():
        return ids.astype("<u4")
    out = []
    for i in ids.tolist():
        if i >= 0:
            out.append(i)
        elif i <= -2_000_000:
            out.extend(model.memory[("long", -2_000_000 - i)])
        else:
            out.extend(model.byte_ids[b] for b in chr(-2 - i).encode("utf-8", "surrogatepass"))
    return np.array(out, "<u4")


def segment(texts: list[str | None], model: Pieces, n: int = BEST) -> list[list[tuple[float, np.ndarray]]]:
    """For each whole text, its n best (score, ids), best first.

    Null and empty texts have one segmentation, without pieces; a text that can be cut in fewer than n ways has
    fewer. Of segmentations with equal scores, which come first is settled by the order of the search.
    """
    shown = [marked(t or "") for t in texts]
    empty = [(0.0, np.zeros(0, "<u4"))]
    if not any(shown):
        return [empty for _ in shown]
    chars, first, last, best, loss, token = forward(shown, model)
    out, end = [], np.cumsum([len(t) for t in shown])
    for t, b in zip(shown, end.tolist()):
        if not t:
            out.append(empty)
            continue
        a = b - len(t)
        p, q = np.searchsorted(first, (a, b))
        total = float(best[p:q].sum())
        found = [(total, _ids(token[a:b], model))]
        if n > 1:
            # alternatives of any but the n - 1 parts that lose least cannot be among the n best
            loses = loss[p:q]
            loose = np.flatnonzero(loses <= np.partition(loses, n - 2)[n - 2]) if q - p >= n else np.arange(q - p)
            loose = [p + int(i) for i in loose[np.argsort(loses[loose], kind="stable")][: n - 1] if np.isfinite(loses[i])]
            choices: list[tuple[float, tuple]] = [(0.0, ())]
            for i in sorted(loose):
                chosen = tuple(_ids(token[first[i] : last[i]], model).tolist())
                others = [x for x in _alternatives(t[first[i] - a : last[i] - a], model, n) if x[1] != chosen][: n - 1]
                grown = [(lost + best[i] - s, swaps + ((i, ids),)) for lost, swaps in choices for s, ids in others]
                choices = sorted(choices + grown, key=lambda c: c[0])[:n]
            for lost, swaps in choices[1:]:
                pieces, at = [], a
                for i, ids in swaps:
                    pieces += [_ids(token[at : first[i]], model), np.array(ids, "<u4")]
                    at = last[i]
                found.append((total - float(lost), np.concatenate(pieces + [_ids(token[at:b], model)])))
        out.append(found)
    for key in [k for k in model.memory if k[0] == "long"]:
        del model.memory[key]
    return out


def _alternatives(part: str, model: Pieces, n: int) -> list:
    known = model.memory.get(("part", part, n))
    if known is None:
        known = search(part, model, n)
        if len(model.memory) < REMEMBERED and len(part) <= LONG:
            model.memory[("part", part, n)] = known
    return known


def _joined(ids, model: Pieces) -> bytes:
    """The pieces of ids in UTF-8, one after the other; byte pieces as their bytes."""
    raw = model.memory.get(("bytes",))
    if raw is None:
        raw = [x.encode() for x in model.names]
        for b, i in enumerate(model.byte_ids):
            raw[i] = bytes((b,))
        model.memory[("bytes",)] = raw
    return b"".join([raw[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])


def decode(ids, model: Pieces) -> str:
    """The text of ids: pieces joined, byte pieces as UTF-8 (what is none as U+FFFD), marks as spaces."""
    whole = _joined(ids, model).decode("utf-8", "replace")
    return whole.replace(SPACE, " ")[1:] if whole.startswith(SPACE) else whole.replace(SPACE, " ")


def decode_alike(a: np.ndarray, b: np.ndarray, model: Pieces) -> bool:
    """Whether two segmentations decode to one text; what they share at both ends is not joined again."""
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    head = int(apart[0]) if len(apart) else n
    n -= head
    apart = np.flatnonzero(a[len(a) - n :] != b[len(b) - n :])
    tail = n - 1 - int(apart[-1]) if len(apart) else n
    x, y = (_joined(c[head : len(c) - tail], model) for c in (a, b))
    return x == y or decode(a, model) == decode(b, model)  # broken bytes may decode alike


def _groups(rows):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[1] or "")
        if size > AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = BEST,
                     model_path: str = MODEL) -> DataFrame:
    """(id, n_tokens, score, ids, scores, ids_sha256, round_trip, alternatives) for each row: one scan, no shuffle.

    score and ids are of the best segmentation, alternatives holds the ids of the others; scores and ids_sha256 (of
    the ids as little-endian 32-bit numbers) are of the n best, best first. round_trip: decoding each of the n best gives
    the text back (for a text that holds the space mark U+2581 none does). Null counts as empty: no ids, score 0. Repeated rows each get their row; an empty
    table gives an empty one; other columns are not looked at.
    """
    model = load(model_path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        for group in _groups(rows):
            for (i, text), best in zip(group, segment([t for _, t in group], model, n)):
                ids, *others = (x.view("<i4") for _, x in best)  # arrays until they are sent: a list takes nine times its memory
                whole = decode(ids, model) == (text or "") and all(decode_alike(ids, x, model) for x in others)
                yield (i, len(ids), best[0][0], ids, [s for s, _ in best],
                       [hashlib.sha256(x.tobytes()).hexdigest() for _, x in best], whole, others)

    return map_rows(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), run,
                    f"`{id_col}` {kind}, n_tokens bigint, score double, ids array<int>, scores array<double>, "
                    "ids_sha256 array<string>, round_trip boolean, alternatives array<array<int>>")


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str = MODEL) -> DataFrame:
    """(id, text) from ids; null ids give an empty text."""
    model = load(model_path)
    kind = encoded.schema[id_col].dataType.simpleString()
    return map_rows(encoded.select(id_col, ids_col), lambda rows: ((i, decode(ids or (), model)) for i, ids in rows),
                    f"`{id_col}` {kind}, text string")


@query("op9_sentencepiece_nbest")
def op9_sentencepiece_nbest(spark, sf_dir):
    """The four best segmentations of every whole text of documents, each decoded again."""
    return encode_documents(table(spark, sf_dir, "documents"))
