"""Conversation repair, line dedup and spelling variants against brute force; queries on whole tables."""

from __future__ import annotations

import collections
import hashlib
import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as wiring
from accountrisk.llm import conversations as C
from accountrisk.llm import line_dedup as L
from accountrisk.llm import variants as V

SMALL = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- conversations --------------------------------------------------------------------------------------
def damage(rows):
    """The contract's damage of (conv_id, turn, role, text) rows, and every original id."""
    left = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        held = left[conv]
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        held += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in left.items()}


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def cheapest(rows):
    """Uniform-cost search over (cost, initials); the automaton of the role initials is written out anew."""
    told = faults(rows)
    queue = [(0, "", 0, "", ())]
    done = set()
    while queue:
        cost, audit, i, roles, out = heapq.heappop(queue)
        tail = roles[-1:] if roles else ""
        if (i, tail) in done:
            continue
        done.add((i, tail))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(out)

        def go(letter, extra, j, initial, turn, cost=cost, audit=audit, roles=roles, out=out):
            new = roles + initial
            # a beginning of s?(ua)+ ; longer histories matter by their last initial only
            if re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(queue, (cost + extra, audit + letter, j, new, out + ((turn,) if turn is not None else ())))

        if i < len(rows):
            _, role, text = rows[i]
            go("D", 3, i + 1, "", None)
            if told[i] not in ("blank", "duplicate"):
                late = told[i] == "truncated"
                if role:
                    go("K", int(late), i + 1, role[0], f"{role}:{text}")
                for r in ("user", "assistant"):
                    go("R", 2 + late, i + 1, r[0], f"{r}:{text}")
        for r in ("user", "assistant"):
            go("I", 2, i, r[0], f"{r}:")
    raise AssertionError


def expected_repairs(rows):
    found = {}
    for conv, turns in damage(rows).items():
        numbers = [t for t, _, _ in turns if t is not None]
        told = collections.Counter(faults(turns))
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, text = cheapest(turns)
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        found[conv] = (gaps, told["blank"], told["duplicate"], told["truncated"], pairs, cost, audit, sha(text))
    return found


def random_turns(draw, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire", "User"]
    texts = ["Hi.", "yes", "Well!\n", " \n", "", None, "a?b", "one. two", "ä …", "z.\t "]
    return [
        (conv, draw.choice([i, i, i, i + 7, None, 3]), draw.choice(roles[: draw.choice([4, 5, 10])]), draw.choice(texts) if draw.random() < 0.7 else f"t{i}.")
        for i in range(n)
    ]


def check_repairs(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit(1)).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in C.repair_conversations(df).collect()}
    assert got == expected_repairs(rows)


@pytest.mark.parametrize("block", [1, 2, 256])
def test_repairs_are_the_cheapest(spark, block, monkeypatch):
    """Also with blocks of one and two rows, whose earlier initials are told by rank only (in this process)."""
    draw = random.Random(block)
    rows = [r for conv in [None, *range(300)] for r in random_turns(draw, conv, draw.randint(1, 9))]
    if block == 256:
        check_repairs(spark, rows)
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    want = expected_repairs(rows)
    for conv, turns in damage(rows).items():
        held = C.Conversation(conv)
        for (turn, role, text), fault in zip(turns, faults(turns), strict=True):
            held.add(turn, role, text, fault)
        assert held.result() == (conv, *want[conv])


def test_long_and_empty_conversations(spark):
    draw = random.Random(9)
    long = random_turns(draw, 1, 900)
    check_repairs(spark, [*long, (2, None, None, None), (3, 5, "user", "x" * 200_000 + ".")])
    schema = "conv_id string, turn int, role string, text string"
    assert C.repair_conversations(spark.createDataFrame([], schema)).collect() == []


def test_order_of_integers():
    """Costs first, then initials; a sequence comes before its extensions."""
    scalars = C.Scalars(6)

    def value(cost, letters):
        v = cost << scalars.low
        for letter in reversed(letters):
            v = scalars.before(letter, 0, v)
        return v

    draw = random.Random(1)
    words = [(draw.randint(0, 3), "".join(draw.choice("DIKR") for _ in range(draw.randint(0, 6)))) for _ in range(300)]
    assert sorted(words) == sorted(words, key=lambda w: value(*w))
    assert all(scalars.read(value(*w)) == w for w in words)


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in wiring.queries()["op11_conversations"](spark, SMALL).collect()}
    assert got == expected_repairs(rows)


# ---- lines ----------------------------------------------------------------------------------------------
def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def expected_lines(rows, min_docs, keep_first=False, min_chars=1):
    """Counter of (id, n_lines, n_dropped, kept); rows are documents, equal rows share the first occurrence."""
    lists = [(i, t, (t or "").split("\n")) for i, t in rows]
    holders = collections.defaultdict(list)
    for i, t, lines in lists:
        for key in {line_key(x) for x in lines}:
            holders[key].append((i is not None, i or 0, t))
    found = collections.Counter()
    for i, t, lines in lists:
        keys = [line_key(x) for x in lines]
        gone = [len(k) >= min_chars and len(holders[k]) >= min_docs for k in keys]
        if keep_first:
            for place, k in enumerate(keys):
                if gone[place] and keys.index(k) == place and min(holders[k], key=lambda h: h[:2]) == (i is not None, i or 0, t):
                    gone[place] = False
        found[(i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g))] += 1
    return found


LINES = [
    (None, "Shared\nown"), (None, "Shared\nown"), (None, None), (1, ""), (2, " SHARED \r\nx\nshared"), (3, "x\n\n\n \nx"), (4, "Ä shared\nä"),
    (5, "shared" + "\ny" * 3000), (6, "shared\x0b\nX"), (7, "ẞ\nʼ\x1cshared"), (8, "same"), (8, "same"), (80, "other\nsame"),
]


@pytest.mark.parametrize("min_docs", [1, 2, 3, 5])
@pytest.mark.parametrize("keep_first", [False, True])
def test_lines(spark, min_docs, keep_first):
    df = spark.createDataFrame([(i, t, 5) for i, t in LINES], "doc_id long, text string, n_lines int").repartition(3)
    got = L.drop_repeated_lines(df, min_docs, keep_first=keep_first)
    rows = collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect())
    assert rows == expected_lines(LINES, min_docs, keep_first)


def test_bitmaps_tell_the_kept_lines(spark):
    df = spark.createDataFrame(LINES, "doc_id long, text string")
    drops = L.repeated_lines(df, 3, min_chars=2)
    got = L.with_keep_bitmaps(df, drops)
    assert "text" not in got.columns
    want = expected_lines(LINES, 3, min_chars=2)
    for r in got.collect():
        bits = L.inflated(r.keep_bits, r.n_lines)
        assert r.n_dropped == r.n_lines - int(bits.sum())
        assert any(k[:3] == (r.doc_id, r.n_lines, r.n_dropped) for k in want)
    empty = df.where("false")
    assert L.drop_repeated_lines(empty).collect() == []


@pytest.mark.parametrize("cuts", [1, 3, 8])
def test_runs_over_partition_borders(cuts):
    """Decisions do not depend on where the sorted records are cut, nor does a task hold more than min_docs of them."""
    draw = np.random.default_rng(cuts)
    for _ in range(200):
        keys = np.sort(draw.integers(0, 4, 30))
        records = [(int(k), 0, str(i), [i], int(draw.integers(1, 3))) for i, k in enumerate(keys)]
        ends = sorted(draw.integers(0, 31, cuts - 1).tolist())
        parts = [records[a:b] for a, b in zip([0, *ends], [*ends, 30])]
        need = int(draw.integers(1, 12))
        events = [(p, *e) for p, part in enumerate(parts) for e in L.stream_runs(iter(part), need)]
        totals = collections.Counter()
        first = {}
        for p, kind, high, _, _, _, n in events:
            if kind == "edge":
                totals[high] += n
                first.setdefault(high, p)
        assert sum(e[1].startswith("open") for e in events) <= 2 * cuts * max(need, 1)
        dropped = {e[4] for e in events if e[1] in ("drop", "lead") or e[1].startswith("open") and totals[e[2]] >= need}
        leads = {e[4] for e in events if e[1] == "lead" or e[1] == "open lead" and totals[e[2]] >= need and e[0] == first[e[2]]}
        n = collections.Counter()
        for r in records:
            n[r[0]] += r[4]
        want = [r for r in records if n[r[0]] >= need]
        assert dropped == {r[2] for r in want}
        assert leads == {next(r[2] for r in want if r[0] == k) for k in {r[0] for r in want}}


def test_line_query_equals_its_sql(spark):
    got = {tuple(r) for r in wiring.queries()["op12_line_dedup"](spark, SMALL).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert got == set(con.execute(wiring.oracle_sql()["op12_line_dedup"]).fetchall()) and any(r[2] for r in got)


# ---- words ----------------------------------------------------------------------------------------------
def brute_words(rows, min_chars=7):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """All pairs by deleted code points, each verified."""
    by_key = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_key[w[:i] + w[i + 1 :]].add(w)
        by_key[w].add(w)
    near = collections.defaultdict(set)
    for group in by_key.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    return near


def brute_variants(counts):
    near = neighbours(counts)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
    found = {}
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        found[w] = (forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None)
    return found


def variants_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variant_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = variants_of(wiring.queries()["op13_spelling_variants"](spark, folder))
    assert got == brute_variants(brute_words(rows))


@pytest.mark.parametrize("expand_at, qmax", [(3, 6), (20, 5), (40, 4)])
def test_variants_of_close_words(spark, expand_at, qmax):
    """Few letters, many near words, long frequent grams: every bound and limit is put to use."""
    draw = random.Random(qmax)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(7, 10))) for _ in range(400)] + ["a" * k for k in (7, 8, 9, 60, 61, 300)]
    text = [(i, " ".join(draw.choice(words) for _ in range(120)) + " " + " ".join(words[-6:])) for i in range(40)]
    chain = [(100 + i, " ".join(["abcdefgh"] * 2 + ["abcdefghi"] * 20 + ["abcdefghij"] * 220)) for i in range(1)]
    rows = [*text, *chain, (None, "ABCDEFGHIJ Éabcdefg éABCDEFG ab×÷defg"), (None, None), (7, ""), (7, text[7][1]), (7, "short a\x00bcdefgh")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(4)
    got = variants_of(V.spelling_variants(df, qmax=qmax, expand_at=expand_at))
    assert got == brute_variants(brute_words(rows))
    assert V.spelling_variants(df.where("false")).collect() == []


def test_bounds_hold_for_random_dictionaries():
    """The rarest gram that an edit leaves alone is in a common list of both words."""
    draw = random.Random(3)
    for _ in range(60):
        words = ["".join(draw.choice("abc") for _ in range(draw.randint(7, 11))) for _ in range(80)]
        qmax = draw.choice([3, 4, 6])
        counts, parents = {}, None
        for q in range(2, qmax + 1):
            level = collections.Counter(
                g for w in words for s in ["\x02" + w + "\x03"] for p in range(len(s) - q + 1) for g in [s[p : p + q]] if parents is None or g[:-1] in parents
            )
            counts |= level
            parents = {g for g, n in level.items() if n >= draw.choice([2, 8, 20])}
        index = V.GramIndex(counts)
        lists = {w: index.lists(w) for w in words}
        for a in words:
            for b in words:
                if a < b and one_edit(a, b) and (lists[a][1] or lists[b][1]):
                    assert {c for c, _ in lists[a][0]} & {c for c, _ in lists[b][0]}, (a, b)
