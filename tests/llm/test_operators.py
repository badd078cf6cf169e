"""Training-data operators against brute force on small tables: nulls, empty and long texts, ties, repeats, extras."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accountrisk.llm import bpe, decontaminate, html_text, jaccard, pii, pu_quality, quality_rules, records, suffix_dedup, warc
from accountrisk.session import new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string"
EDGE = [(9000, None), (9001, ""), (9002, " \n "), (9003, "one"), (9004, "Ünï  ça"), (9005, "x" * 5000), (None, "no id here"), (9006, "same row"), (9006, "same row")]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# ---- decontamination ------------------------------------------------------------------------------------
def brute_hits(items, words, window):
    hit, found = [False] * len(words), set()
    for key, ws in items:
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == ws[i : i + n]:
                    found.add(key)
                    hit[j : j + n] = [True] * n
    return sum(hit), found


@pytest.mark.parametrize("seed", range(5))
def test_automaton_finds_what_brute_force_finds(seed):
    draw = random.Random(seed)
    for _ in range(200):
        window, letters = draw.choice([2, 3, 5]), [b"a", b"b", b"c"][: draw.choice([2, 3])]
        items = [(str(i), [draw.choice(letters) for _ in range(draw.randint(0, 9))]) for i in range(draw.randint(0, 4))]
        words = [draw.choice([*letters, b"z"]) for _ in range(draw.randint(0, 25))]
        spans, found = decontaminate.Automaton(items, window).hits(words)
        assert (sum(b - a for a, b in decontaminate.union_of(spans)), found) == brute_hits(items, words, window)


@pytest.mark.parametrize("block_words", [5, 1000])
def test_decontaminate(spark, block_words):
    item = " ".join(f"w{i}" for i in range(20))
    items = frame(spark, [(1, item), (2, "Short ITEM"), (3, None), (None, "lone words"), (4, "")], "item_id long, text string")
    rows = [(1, f"start {item.upper()} end"), (2, "a short-item b " + "z " * 100), (3, "lone words"), *EDGE]
    docs = frame(spark, [(i, t, 5) for i, t in rows], DOCS + ", n_words int")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items, block_words=block_words).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].item_ids, got[1].contaminated) == (22, 20, ["1"], True)
    assert got[1].clean_text == "start  end"
    assert (got[2].n_hit, got[2].item_ids, got[2].contaminated) == (2, ["2"], False)
    assert (got[3].n_hit, got[3].item_ids, got[3].contaminated) == (2, [], True)
    assert got[9000].clean_text is None and got[9000].n_words == 0 and not got[9001].contaminated
    none = decontaminate.decontaminate(docs, items.where("false")).agg(F.sum("n_hit")).first()[0]
    assert none == 0


def test_blocks_of_a_large_benchmark_add_up(spark):
    """Many blocks, each with a pass of its own, give what brute force gives; copies and null ids included."""
    draw = random.Random(8)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 12)))) for i in range(40)]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60)))) for i in range(60)]
    rows += [(100, rows[5][1]), (None, rows[5][1]), (None, rows[7][1]), (101, None)]
    table = frame(spark, items, "item_id long, text string")
    blocks = decontaminate.item_blocks(table, "item_id", "text", 30, 4)
    assert blocks.count() >= sum(len(t.split()) for _, t in items) / 30
    docs = frame(spark, [(*r, "x") for r in rows], DOCS + ", text_key string")
    got = sorted((repr(r.doc_id), r.n_hit, r.item_ids) for r in decontaminate.decontaminate(docs, table, window=4, block_words=30).collect())
    want = []
    for key, text in rows:
        n_hit, found = brute_hits([(str(i), t.encode().split()) for i, t in items], (text or "").encode().split(), 4)
        want.append((repr(key), n_hit, sorted(found)))
    assert got == sorted(want)


def test_rows_of_equal_short_hashes_are_apart(spark):
    """Null ids and two texts that agree in 31 bits of a hash: bytes go from the text that repeats only."""
    def text(k):
        return F.concat_ws(" ", *[F.concat(F.lit(f"{j}x"), k, F.lit(f"y{j}")) for j in range(40)])

    rows = spark.range(150_000).select(F.col("id"), F.xxhash64(text(F.col("id").cast("string")).cast("binary")).bitwiseAND(0x7FFFFFFF).alias("h"))
    twins = rows.groupBy("h").agg(F.collect_list("id").alias("ids")).where("size(ids) > 1").first().ids
    docs = spark.createDataFrame([(k,) for k in [*twins[:2], twins[0]]], "k long").select(F.lit(None).cast("long").alias("doc_id"), text(F.col("k").cast("string")).alias("text"))
    got = sorted(len(r.kept) for r in suffix_dedup.remove_repeats(docs).collect())
    sizes = {k: n for k, n in docs.selectExpr("text", "length(text) AS n").distinct().collect()}
    assert got == [0, 0, max(got)] and max(got) in sizes.values() and max(got) > 300


def test_personal_data_alone_and_beside_others(spark):
    """A text's spans do not depend on its neighbours; secrets are found whole, in quotes and out of them."""
    draw = random.Random(3)
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    forms = ["972-980-6351", "(212) 555-0147", "a@b.com", "x at y", "+49 30 1234567", "info [at] example [dot] org", f'token = "{secret}"', "10.1.2.3", "word", "The end."]
    texts = [" ".join(draw.choice(forms) for _ in range(draw.randint(0, 3))) for _ in range(300)]
    rows = list(enumerate(texts))
    together = {r.doc_id: (r.base, r.pii) for r in pii.find_pii(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()}
    apart = {r.doc_id: (r.base, r.pii) for r in pii.find_pii(spark.createDataFrame(rows, DOCS).repartition(60)).collect()}
    assert together == apart
    held = [any(s.kind == "secret" and text[s.start : s.end] == secret for s in together[i][1]) for i, text in rows if secret in text]
    assert np.mean(held) > 0.8 and len(held) > 30
    assert not any(s.kind == "secret" for i, text in rows if secret not in text for s in together[i][1])
    line = f'some words here\nand token = "{secret}" in a line'
    (found,) = pii.find_pii(spark.createDataFrame([(1, line)], DOCS)).collect()
    assert [(s.kind, line[s.start : s.end]) for s in found.pii] == [("secret", secret)]
    assert pii.find_pii(spark.createDataFrame([], DOCS)).collect() == []


# ---- tokens ---------------------------------------------------------------------------------------------
TEXTS = ["<|endoftext|> x<|startoftext|>y A<|endoftext|>", "ΑΣ ΣΑΣ İI", "aaaaaaa aaaa", "é ́x", "it's 'sample they'll 12345", "a\x1cb \x1f", "<| <|endoftext", "日本語 テスト", "a" * 3000 + " b"]


def test_one_pass_gives_what_two_give(spark, monkeypatch):
    """Also with a memo so small that it starts anew all the time."""
    docs = frame(spark, [(*r, 1) for r in EDGE + list(enumerate(TEXTS * 3))], DOCS + ", decoded int")
    two = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER)
    one = bpe.encode_and_decode(docs, TOKENIZER)
    assert one.columns == two.columns and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    tables = bpe.load_tables(TOKENIZER)
    small, large = bpe.BpeEncoder(tables), bpe.BpeEncoder(tables)
    small.memo = bpe.ByteBoundMemo(small.encode_chunks, 200)
    for text in TEXTS * 2:
        a, b = (e.encode(pa.array([text, "", text])) for e in (small, large))
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_bpe_equals_the_library(spark):
    rows = EDGE + list(enumerate(TEXTS))
    library = Tokenizer.from_file(TOKENIZER)
    done = bpe.decode(bpe.encode(frame(spark, [(*r, 1) for r in rows], DOCS + ", ids int"), TOKENIZER), TOKENIZER).collect()
    assert len(done) == len(rows)
    for r in done:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids, r.text
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(frame(spark, []), TOKENIZER).count() == 0


def test_record_words_are_merged_once(monkeypatch):
    """The library meets a word once, in whatever chunks and steps it stands, until the memo starts anew."""
    library = Tokenizer.from_file(TOKENIZER)
    texts = [None, "", " ", "the Theorem, the", "a\x1cb c\x1f", "x<|endoftext|>y <|endoftext|><|startoftext|>", "<|ENDOFTEXT|> <| a |>"]
    texts += ["ΑΣ ΣΑΣ ς é é İ", "\n\n a\u00a0b c\u0085d", "z" * 5000, "'s don't 12345 #$%", "日本語 😀 \x00", "(the) theorem"]
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder, met = records.LibraryEncoder(open(TOKENIZER, encoding="utf-8").read()), []
    merge = encoder.word_memo.encode_new
    encoder.word_memo.encode_new = lambda words: met.extend(words.to_pylist()) or merge(words)

    def same(order):
        flat, offsets = encoder.encode(pa.array([texts[k] for k in order], pa.string()))
        return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [wanted[k] for k in order]

    assert same([]) and same([0, 1]) and not met
    assert same(range(6)) and same(range(len(texts))) and same([12, 3])
    assert {"the", "theorem"} <= set(met) and len(met) == len(set(met))
    monkeypatch.setattr(records, "MEMO_BYTES", 0)
    assert same(range(len(texts))) and same([3, 12, 3])
    assert met.count("the") > 1


def test_records_round_trip(spark):
    rows = EDGE + [(i, f"text {i} " * (i % 7)) for i in range(300)]
    library = Tokenizer.from_file(TOKENIZER)
    manifest = records.write_records(frame(spark, rows), TOKENIZER, 1, new_path(spark, "records"), shard_bytes=300)
    assert manifest.count() > 4
    got = records.read_records(manifest, shuffle_seed=3).orderBy("record_no").collect()
    assert [r.record_no for r in got] == list(range(len(rows)))
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    text, start = dict(rows), 0
    for r in got:
        ids = [*library.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert records.write_records(frame(spark, []), TOKENIZER, 1, new_path(spark, "records")).count() == 0


def test_record_frames_notice_damage():
    data = records.frame(b"\x02abcd")
    assert records.unframed(data) == b"\x02abcd"
    for k in range(len(data)):
        with pytest.raises(records.CorruptRecord):
            records.unframed(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :])


# ---- quality --------------------------------------------------------------------------------------------
def test_pu_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = pu_quality.score_quality(docs.withColumn("score", F.lit("clash")), labels)
    assert scored.count() == docs.count() and set(docs.columns) < set(scored.columns)
    held = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert sum(r.quality == r.predicted for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    # labels of held-out rows have no influence
    other = labels.withColumn("quality", F.when(pu_quality.is_held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    model, again = (pu_quality.fit_quality(docs, x) for x in (labels, other))
    assert np.allclose(model.weights, again.weights) and 0.7 < model.prior < 0.95


def test_pu_edges(spark):
    labels = frame(spark, [(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    scores = pu_quality.score_quality(frame(spark, EDGE), labels).collect()
    assert len(scores) == len(EDGE) and all(r.score == 0.5 for r in scores)
    assert pu_quality.score_quality(frame(spark, []), labels).count() == 0


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = collections.Counter(windows)
    cover = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover), failed


def test_quality_rules(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 60))) + draw.choice(["", "\n x\n x\n", "\t\x0b"])) for i in range(150)]
    rows += EDGE + [(8000 + i, " ".join(f"w{draw.randint(0, 999)}" for _ in range(60))) for i in range(300)] + [(8500, "w# $$ " * 5 + " ".join(f"%{i}%" for i in range(60)))]
    docs = frame(spark, [(i, t, "en" if (i or 0) % 3 else None, "s") for i, t in rows], DOCS + ", lang string, source string")
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(r.text)
        assert not (r.kept and r.base_failed)
        if 8000 <= (r.doc_id or 0) < 9000:
            assert r.kept == (r.doc_id != 8500)
    assert quality_rules.apply_rules(docs.where("false")).count() == 0


def test_quality_fences_follow_the_group(spark):
    draw = random.Random(5)

    def text(symbols, size, lines=0):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(size - 2, size + 2))) for _ in range(60)]
        return " ".join(w + "#" * (draw.random() < symbols) for w in words) + "\n same" * lines

    rows = [(text(0, 5), "prose") for _ in range(300)] + [(text(0.9, 5), "code") for _ in range(300)] + [(text(0, 9), "terms") for _ in range(300)]
    rows += [(text(0, 5, draw.randint(2, 9)), "lists") for _ in range(60)] + [(text(0, 5), "lists") for _ in range(240)]
    usual, probes = len(rows), [text(0.3, 5), text(0, 9), text(0, 5, 9), text(0, 3), text(0, 5)]
    rows += [(t, s) for t in probes for s in ("prose", "code", "terms", "lists")]
    docs = frame(spark, [(i, t, "en", s) for i, (t, s) in enumerate(rows)], DOCS + ", lang string, source string")
    measured = quality_rules.measure(docs)
    cuts = {r.f_source: r for r in quality_rules.fences(measured).collect()}
    assert cuts["code"].high_symbol_share > 3 * cuts["prose"].high_symbol_share
    assert cuts["lists"].high_dup_line_share > 3 * cuts["prose"].high_dup_line_share and cuts["prose"].high_repeat_share < 0.3
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    assert sum(kept[i] for i in range(usual)) > 0.99 * usual
    of = {(n, s): kept[usual + 4 * n + k] for n in range(5) for k, s in enumerate(("prose", "code", "terms", "lists"))}
    assert not of[0, "prose"] and not of[0, "lists"] and not of[1, "prose"] and of[1, "terms"]
    assert not of[2, "prose"] and of[2, "lists"]
    assert not of[3, "prose"] and not of[4, "terms"] and of[4, "prose"]


# ---- personal data --------------------------------------------------------------------------------------
PATTERNS = [
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(pii.digits_of(m)) <= 19 and pii.luhn(pii.digits_of(m))),
    (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(pii.digits_of(m)) <= 15),
]


def brute_pii(text):
    return [(k, *m.span()) for k, (p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m.group())]


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choice(draw.choice(["a@.-1", "1.25", "12 -+().", " \n@x.%é4"])) for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(text) == brute_pii(text), text


def test_viterbi_skips_nothing():
    field = pii.train(pii.training_rows(2), rounds=15)
    for text in ["x (555) 123-4567 y 020 7946 0958 z\n4111.1111.1111.1111 + 22", "plain words, and 12.5 of them\n" * 30, "1-2 " * 200]:
        shapes = pii.tokens_of(np.frombuffer((text + "\n").encode("utf-32-le"), np.uint32))[2]
        scores = field.scores(shapes)
        scores[(shapes % (pii.N_SHAPES // 2)) == pii.LINE, 1:] = -1e9
        full = pii.best_paths(scores[None], np.array([len(shapes)]), field.move)[0]
        assert (pii.viterbi(field, shapes) == full).all()


def test_find_and_redact(spark):
    rows = [(1, "mail é a.b@mail.example.org, ip 10.0.0.1, +49 30 1234567"), (2, "call (555) 123-4567 now"), (3, "year 1999, v 2.0.1"), *EDGE]
    found = pii.find_pii(frame(spark, [(*r, 0) for r in rows], DOCS + ", base int"))
    got = {r.doc_id: r for r in found.collect()}
    assert [(s.kind, got[1].text[s.start : s.end]) for s in got[1].base] == [("email", "a.b@mail.example.org"), ("ip", "10.0.0.1"), ("phone", "+49 30 1234567")]
    assert not got[2].base and [got[2].text[s.start : s.end] for s in got[2].pii] == ["(555) 123-4567"]
    assert not got[3].pii and not got[9000].pii
    clean = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert clean[1] == "mail é <email>, ip <ip>, <phone>" and clean[9000] is None and clean[3] == rows[2][1]


# ---- near duplicates ------------------------------------------------------------------------------------
def brute_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().translate(jaccard._LOWER).split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            overlap = len(sets[a] & sets[b])
            if overlap and 100 * overlap >= 75 * (len(sets[a]) + len(sets[b]) - overlap):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("dense", [0, 4])
@pytest.mark.parametrize("frequent", [8, 10_000])
def test_jaccard_components(spark, monkeypatch, frequent, dense):
    monkeypatch.setattr(jaccard, "DENSE", dense)
    monkeypatch.setattr(jaccard, "TOTAL_COUNT", frequent)
    monkeypatch.setattr(jaccard, "TILE", 16)
    monkeypatch.setattr(jaccard, "SALTS", 3)
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base, common = [draw.choice(words) for _ in range(60)], [draw.choice(words) for _ in range(30)]
    rows = [(i, " ".join(w if draw.random() > draw.choice([0.01, 0.05, 0.1]) else draw.choice(words) for w in base)) for i in range(100)]
    rows += [(1000 + i, " ".join(common + [draw.choice(words) for _ in range(draw.choice([5, 20, 60]))])) for i in range(100)]
    rows += [r for r in EDGE if r[0] is not None]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(frame(spark, rows)).collect()}
    assert got == brute_components(rows)
    assert jaccard.link_documents(frame(spark, rows[:0])).count() == 0


# ---- repeats --------------------------------------------------------------------------------------------
def brute_repeats(rows, length=200):
    count = collections.Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        out.append((i, len(b), sum(gone), sum(1 for r in bytes(gone).split(b"\0") if r), bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [3, 20_000])
def test_repeats_are_removed(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "TOTAL_COUNT", 6)
    monkeypatch.setattr(suffix_dedup, "LOCAL_COUNT", 2)
    draw = random.Random(1)

    def drawn(n):
        return "".join(draw.choice("abcdé ") for _ in range(n))

    pieces = [drawn(k) for k in (150, 199, 200, 201, 230, 500, 900)]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(draw.randint(0, 6)):
            p, k = draw.choice(pieces), draw.randrange(5)
            j = draw.randrange(len(p))
            text += [p, p[j // 4 :], p[: len(p) - j // 4], p[:j] + "X" + p[j + 1 :], drawn(draw.randint(1, 300))][k]
        rows.append((i, text))
    rows += EDGE + [(1000, "a" * 700), (1001, "ab" * 400), (1004, "x" * 199), (1006, rows[5][1]), (1006, rows[5][1]), (1006, "other")]
    got = suffix_dedup.remove_repeats(frame(spark, [(*r, 1) for r in rows], DOCS + ", kept int")).collect()
    made = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got]
    assert sorted(made, key=repr) == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


# ---- pages ----------------------------------------------------------------------------------------------
def test_warc_round_trip(spark):
    same, short = "<p>" + "x" * 200, "tiny"
    rows = [(5, "http://a/", same), (2, None, same), (9, "http://c/", same), (3, "u", short), (4, "u", short), (6, "u", None), (7, "u", ""), (8, "u\r\nX: y", "é" * 100), (8, "u", "other" * 50)]
    pages = frame(spark, rows, "page_id long, url string, html string")
    files = warc.write_archives(pages, new_path(spark, "warc"))
    captures = warc.transactions(warc.read_archives(files, with_payload=True)).collect()
    assert len(captures) == len(rows)
    assert all(len(c.requests) == len(c.metadata) == 1 and not c.others for c in captures)
    got = sorted((int(c.main.page_id), c.main.record_type, c.main.refers_to, c.main.payload_bytes, c.main.payload_digest) for c in captures)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        revisit = html == same and i != 2
        want.append((i, "revisit" if revisit else "response", "2" if revisit else None, len(body), sha(body)))
    assert got == sorted(want)
    assert warc.transactions(warc.read_archives(warc.write_archives(pages.where("false"), new_path(spark, "warc")))).count() == 0


def test_transactions_follow_links_both_ways(spark):
    rows = [("r1", "response", "q1"), ("q1", "request", None), ("m1", "metadata", "q1"), ("r2", "revisit", None), ("q2", "request", "r2"), ("lost", "metadata", "nowhere")]
    got = {c.capture_id: c for c in warc.transactions(spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to string")).collect()}
    assert set(got) == {"r1", "r2", "lost"} and got["lost"].main is None
    assert [x.record_id for x in got["r1"].requests] == ["q1"] and [x.record_id for x in got["r1"].metadata] == ["m1"]


def test_transactions_of_repeated_headers_and_long_chains(spark):
    """Every named record counts, chains have any length, and records without an id stay apart."""
    rows = [
        ("r1", "response", ["x", "q1"]), ("q1", "request", None), ("m1", "metadata", ["q1"]), ("m2", "metadata", ["m1"]), ("m3", "metadata", ["m2"]),
        ("r0", "revisit", []), ("q0", "request", ["gone", "r0"]), ("both", "request", ["r1", "r0"]), (None, "metadata", ["r1"]), (None, "response", []),
        ("l1", "metadata", ["l2"]), ("l2", "metadata", ["l1"]), ("odd", None, [None, "r0"]), ("q0", "metadata", ["r0"]),
    ]
    records = spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to array<string>")
    got = {c.capture_id: c for c in warc.transactions(records).collect()}
    ids = {k: sorted(x.record_id or "-" for x in [*c.requests, *c.metadata, *c.others]) for k, c in got.items() if not k.startswith("unnamed")}
    assert ids == {"r1": ["m1", "m2", "m3", "q1"], "r0": ["both", "odd", "q0", "q0"], "l1": ["l1"], "l2": ["l2"]}
    assert sorted(c.main is not None for k, c in got.items() if k.startswith("unnamed")) == [False, True]


def test_warc_records_can_be_followed(spark):
    """A revisit names the record that holds the payload; repeated headers are all kept; folders get their scheme."""
    same = "<p>" + "y" * 300
    rows = [(3, "a", same, 7), (3, "b", same, 7), (8, "c", same, 7), (None, "d", same, 7), (None, "d", same, 7), (4, "e", None, 7)]
    pages = frame(spark, rows, "page_id long, url string, html string, digest int")
    files = warc.write_archives(pages, new_path(spark, "warc"))
    assert all(f.path.startswith("file:") for f in files.collect())
    found = warc.read_archives(files).collect()
    ids = {r.record_id: r for r in found}
    assert len(ids) == len(found) == 3 * len(rows)
    (revisit,) = [r for r in found if r.record_type == "revisit"]
    assert (revisit.page_id, revisit.refers_to, ids[revisit.refers_to_id].page_id, ids[revisit.refers_to_id].record_type) == ("8", "3", "3", "response")
    raw = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: <a>\r\nwarc-concurrent-to: <b>\r\nContent-Length: 2\r\n\r\nxy\r\n\r\n"
    assert warc.parsed(raw) == ({"warc-type": ["metadata"], "warc-concurrent-to": ["<a>", "<b>"], "content-length": ["2"]}, b"xy")


def test_folders_that_tasks_cannot_open_are_refused(spark):
    assert records.shared_folder(spark, new_path(spark, "plain")).startswith("file:/")
    with pytest.raises(ValueError):
        records.place("/no/scheme")
    with pytest.raises(ValueError):
        records.place("odd://host/x")


HTML = [
    ("<p>one<p>two <b>bold</b>text<br>line", "one\n\ntwo boldtext\nline"),
    ("<ul><li>x<li>y<ol start=3><li>a<li>b</ol><li>z</ul>", "- x\n- y\n  3. a\n  4. b\n- z"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>both</table>", "Name      | N\nlong name | 1\nboth"),
    ("<div hidden>no</div><div style='display: none'>no</div><script>1<2</script>a &amp; b<!-- c --> d", "a & b d"),
    ("<pre> a\n  b</pre>", " a\n  b"),
    ("a<b", "a"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("source, text", HTML)
def test_html_layout(source, text):
    assert html_text.visible_text(source) == text


SEEN = [
    ("<img src=a alt=Bob's><p>Hello visible words.</p><p>It's fine</p>", "Bob's\n\nHello visible words.\n\nIt's fine"),
    ("<p \" class=x>y</p>z<p a = 'q>r'>s<p =\"a>t", "y\n\nz\n\ns\n\nt"),
    ("<p aria-hidden=true>shown</p><p hidden>no</p>", "shown"),
    ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
    ("say <textarea>\na &lt; b\nc</textarea>", "say a < b\nc"),
    ("<select><option>a<option selected>b<option>c</select>", "b"),
    ("<select><option disabled>a<option>b</select> <select multiple><option>c<option>d</select>", "b c d"),
    ("<svg><title>no</title><desc>no</desc><text>in</text><text>picture</text></svg>", "in picture"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>x<td rowspan=0>a<tr><td>c<tbody><tr><td>y<td>z</table>", "x | a\nc |\ny | z"),
    ("<table><tr><td>x<td colspan=2 rowspan=2>ab<td>y<tr><td>c<td>d<tr><td>1<td>2<td>3<td>4</table>", "x | ab    | y\nc |       | d\n1 | 2 | 3 | 4"),
]


@pytest.mark.parametrize("source, text", SEEN)
def test_html_shows_what_a_browser_shows(source, text):
    assert html_text.visible_text(source) == text


def test_html_loses_no_text():
    draw = random.Random(4)
    tags = "<p> </p> <li> <ul> </ul> <td> <tr> <table> </table> <b> </b> &lt; <pre> <ol> </ol> <dd> <th> </td>".split()
    for _ in range(3_000):
        source = "".join(draw.choice([*tags, "x", "y ", "\n"]) for _ in range(draw.randint(0, 25)))
        out = html_text.visible_text(source)
        assert (out.count("x"), out.count("y")) == (source.count("x"), source.count("y")), source
    assert html_text.visible_text("<div>" * 20_000 + "x") == "x"


def test_extract_text(spark):
    pages = frame(spark, [(1, "<p>a", 3), (1, "<p>a", 3), (2, None, 4)], "page_id long, html string, text int")
    assert sorted((r.page_id, r.text) for r in html_text.extract_text(pages).collect()) == [(1, "a"), (1, "a"), (2, "")]
