"""Ranked search, repeated bytes and periodic runs against plain versions and on edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import EDGES, LONG, SMALL, docs, table, texts_of

from tonearm.llm import periodic, ranked_search, repeated_bytes
from tonearm.llm.queries import all_queries, with_planted_periods

# ---- ranked search --------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(rows, items, top=10):
    """Scores of all documents for all items, one by one."""
    held = [(i, Counter(plain_terms(t))) for i, t in rows]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, c in held:
            n = sum(c.values())
            score = 0
            for t in plain_terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_search_on_edge_rows(spark, rows):
    items = [(1, "some plain words, SOME words"), (2, None), (3, ""), (4, "none of that xyzzy"), (5, "w1x1 w2x2 中文 É é words😀"), (5, "one"), (6, "a\0b")]
    texts = [*EDGES, (20, "plain plain plain"), (20, "plain words"), (21, "A\0B"), (None, "plain words of")]
    found = ranked_search.ranked(docs(spark, texts), items_frame(spark, items))
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(texts, items)
    assert ranked_search.ranked(docs(spark, []), items_frame(spark, items)).count() == 0
    assert ranked_search.ranked(docs(spark, texts), items_frame(spark, [])).count() == 0


def test_search_in_many_chunks_and_blocks(spark, rows, monkeypatch):
    """Ties, queries of more than 64 terms, several blocks of queries, and few documents a chunk."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    texts = [(i, " ".join(pick.choices(words, [1 / (k + 1) for k in range(150)], k=pick.randint(0, 60)))) for i in range(300)]
    texts += [(1000 + i, texts[5][1]) for i in range(30)]
    items = [(i, " ".join(pick.choices(words, k=n))) for i, n in enumerate([1, 2, 5, 20, 90, 140])]
    monkeypatch.setattr(ranked_search.text_chunks, "__defaults__", (2000,))
    found = ranked_search.ranked(docs(spark, texts), items_frame(spark, items), ranked_search.Ranking(top=7, block_bytes=300))
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(texts, items, 7)


def test_masks_are_left_out_once_no_document_can_enter():
    """Only masks whose bound reaches the last of the list are scored."""
    firsts = np.array([0, 40, 1040])
    row = {
        "doc_ids": np.arange(1040).tobytes(),
        "missing": np.zeros(1040, bool).tobytes(),
        "sizes": np.ones(1040, np.int64).tobytes(),
        "firsts": firsts.tobytes(),
        "docs": np.concatenate([np.arange(40), np.arange(40, 1040)]).astype(np.int32).tobytes(),
        "tfs": np.ones(1040, np.int32).tobytes(),
    }
    seen = []

    class Watched(ranked_search.Best):
        def add(self, scores, missing, doc_ids):
            seen.extend(doc_ids.tolist())
            super().add(scores, missing, doc_ids)

    best = Watched(10)
    ranked_search.Chunk(row, 1040, 1040).search([0, 1], np.array([9, 1]), best, at_once=1)
    assert best.rows[:, 2].tolist() == list(range(10)) and seen == list(range(40))


# ---- repeated bytes -------------------------------------------------------------------------------


def plain_repeated(texts, width):
    """Bytes removed by looking every string up."""
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    found = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if times[d[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        found.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return found


def bytes_found(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect()]


@pytest.mark.parametrize("group_names", [1, 3, 4096])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrst é"])
def test_repeated_bytes_against_every_string(spark, group_names, letters):
    """Copies, parts of copies, texts that overlap themselves, of few letters and of many."""
    pick = random.Random(len(letters))
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(pick.randint(1, 6)):
            kind = pick.random()
            if kind < 0.5 and texts:
                other = pick.choice(texts)
                start = pick.randrange(max(1, len(other)))
                parts.append(other[start : start + pick.randint(1, 120)])
            elif kind < 0.6:
                parts.append("".join(pick.choices(letters, k=pick.randint(1, 5))) * pick.randint(5, 30))
            else:
                parts.append("".join(pick.choices(letters, k=pick.randint(1, 90))))
        texts.append("".join(parts))
    parsing = repeated_bytes.Parsing(width=40, window=4, modulus=8, reach=20, group_names=group_names)
    found = repeated_bytes.remove_repeated(docs(spark, list(enumerate(texts))), parsing)
    expected = [(i, *r) for i, r in enumerate(plain_repeated(texts, 40))]
    assert sorted(bytes_found(found)) == expected
    assert 0 < sum(r[2] for r in expected) < sum(r[1] for r in expected)


def test_repeated_bytes_of_edge_rows(spark):
    texts = [*EDGES, (9, LONG[1000:2000]), (10, "x" * 399), (11, "y" * 400), (12, "z" * 401), (13, "é" * 300), (14, None), (None, "q" * 500)]
    found = sorted(bytes_found(repeated_bytes.remove_repeated(docs(spark, texts))), key=repr)
    expected = [(i, *r) for (i, _), r in zip(texts, plain_repeated([t for _, t in texts], 400))]
    assert found == sorted(expected, key=repr)
    assert repeated_bytes.remove_repeated(docs(spark, [])).count() == 0


def test_triggers_depend_on_their_window_only():
    parsing = repeated_bytes.Parsing(window=11, modulus=4)
    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    whole = set(repeated_bytes.triggers(data, parsing).tolist())
    alone = {i for i in range(len(data) - 10) if len(repeated_bytes.triggers(data[i : i + 11], parsing))}
    assert whole == alone and 500 < len(whole) < 1000
    assert len(repeated_bytes.triggers(data[:10], parsing)) == 0


# ---- periodic runs --------------------------------------------------------------------------------


def plain_runs(words, least=12):
    """All lags, place by place."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_against_every_lag():
    pick = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(pick.randint(1, 4)):
            kinds, words = pick.randint(1, 6), [0]
            while pick.random() < 0.8:
                words += [pick.randint(0, kinds) for _ in range(pick.randint(1, 12))] * pick.randint(1, 5)
                words += [pick.randint(0, 9) for _ in range(pick.randint(0, 3))]
            texts.append(words)
        flat = np.array([w for t in texts for w in t])
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        assert periodic.runs_of(flat, starts, periodic.Periods()) == [plain_runs(t) for t in texts]


def test_segments_split_at_rare_words_until_none_is_left():
    words = np.array([0, 1] * 6 + [2] + [0, 1] * 6 + [3, 4, 5, 4, 5])
    assert periodic.segments(words, np.array([0]), 12) == [(0, 12), (13, 25)]
    # 6 occurs twice until 7 splits the text; then it splits its own part
    words = np.array([0, 1] * 7 + [6] + [0, 1] * 7 + [7] + [0, 1] * 7 + [6])
    assert periodic.segments(words, np.array([0]), 12) == [(0, 14), (15, 29), (30, 44)]


def test_runs_of_edge_rows(spark):
    texts = [*EDGES, (30, "a " * 12), (31, "a " * 11), (32, "x y z\t" * 4 + "\nq"), (33, LONG + " " + LONG), (None, "b " * 20)]
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs(spark, texts)).collect()]
    expected = []
    for i, t in texts:
        words = (t or "").encode().split()
        # words of the long text come back after 30,907: its last 29,093 are its first, and meet them where it is doubled
        runs = [(0, 120_000, 60_000), (30_907, 58_186, 29_093)] if i == 33 else [] if i == 5 else plain_runs(words)
        expected.append((i, len(words), runs))
    assert sorted((f[:3] for f in found), key=repr) == sorted(expected, key=repr)
    for i, n, runs, collapsed in found:
        own = [t for j, t in texts if j == i]
        assert collapsed in {plain_collapsed([w.decode() for w in (t or "").encode().split()], runs) for t in own}
    assert periodic.periodic_runs(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.Periods(least=5)


def planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_planted_periods(spark):
    texts = [(i, f"t{i} " + "u v w x y z " * (i % 7)) for i in range(200)] + [(500, None), (501, ""), (None, "a b c")]
    found = defaultdict(list)
    for r in with_planted_periods(docs(spark, texts)).collect():
        found[r.doc_id].append((r.text or "").split())
    for i, t in texts:
        assert found[i] == [planted(i, t) if i is not None else ["a", "b", "c"]]


def test_op13_against_plain_version(spark):
    found = {r.doc_id: r for r in all_queries()["op13_periodic_runs"](spark, SMALL).collect()}
    for i, t in texts_of(spark):
        words = planted(i, t)
        runs = plain_runs(words) if len(words) < 1500 else None
        if runs is None:
            continue
        r = found[i]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == expected
    assert len(found) == table(spark, "documents").count()
