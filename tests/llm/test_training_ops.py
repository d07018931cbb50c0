"""Training-data operators against brute force, round trips and held-out accuracy, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from harmonia.llm import (bpe_rank, chat, common, embed_dedup, html_layout, induced, langid, lines, minhash, packing, quality,
                          suffix)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, h long, rep string, d int, _d int, _kept int, key string"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "s", 1, "r", 2, 3, 4, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed, vocab=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    base = words(300, 1)
    passage = words(60, 2)
    near = base.split()
    near[10] = "changed"
    lines_ = "\n".join(words(9, 50 + i) + "." for i in range(8))
    return [base, base, " ".join(near), None, "", " \n\t", "one two", "One  TWO", "x" * 130, "ab" * 400, passage + " tail here",
            "head " + passage, lines_, "intro line.\n" + lines_ + "\nend.", words(30000, 3), "é" * 90 + "ü" * 90, "\n" * 200,
            "<|endoftext|> it's 12 ½ <b>", base.upper(), "日本語 テキスト " * 20]


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return docs_of(spark, awkward)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1 -----------------------------------------------------------------------------------------

def test_chat_round_trip_of_hostile_texts(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|body|>x", "\\b\\l[INST\\i]", "", None, "é<\\", "[[INST]]"]
    data = [(1, i, ["user", "assistant", None][i % 3], t, "x") for i, t in enumerate(hostile)]
    data += [(2, None, "assistant", "a", "x"), (2, None, "assistant", "a", "x"), (None, 0, "<|body|>", "z", "x")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")
    from pyspark.sql import functions as F
    got = rows(chat.read_back(chat.format_chat(df.withColumn("parts", chat.text_parts(F.col("text"))))), "conv_id")
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t, _ in data[:7]]
    assert got[1].loss_text == "".join(t or "" for _, _, r, t, _ in data[:7] if r == "assistant")
    assert got[2].n_turns == 2 and got[2].loss_text == "aa" and got[None].turns[0].role == "<|body|>"
    assert got[1].formatted.count(chat.END) == 7


def test_chat_parts_become_ordered_placeholders(spark):
    parts = [("text", "see ", None, None), ("image", None, "i1", 2), ("text", " and <", None, None), ("audio", None, "a1", 10),
             ("document", None, "d1", None), (None, "?", None, None), ("image", "x", None, 1)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chat(df).collect()[0]
    assert "see <|image|> and \\l<|audio|><|document|><|image|>" in r.formatted
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "i1", 512), ("audio", "a1", 250),
                                                                   ("document", "d1", 512), ("image", None, 256)]
    assert r.expanded_tokens == 512 + 250 + 512 + 256
    span = r.loss_spans[0]
    assert r.formatted[span.start:span.start + span.length].startswith("see ")
    assert chat.format_chat(df.limit(0)).count() == 0


# 2 -----------------------------------------------------------------------------------------

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((12, 16))
    vecs = [list(map(float, b + s * rng.standard_normal(16))) for b in base for s in (0, 0, 0.05, 0.12, 0.2, 0.3)]
    data = [(i, v, i % 2 + 0, "x") for i, v in enumerate(vecs)]
    n = len(data)
    data += [(n, vecs[0], None, "x"), (n + 1, None, 0, "x"), (n + 2, [], 0, "x"), (n + 3, [0.0] * 16, 0, "x"),
             (n + 4, [None] + [1.0] * 15, 0, "x"), (n + 5, [float("nan")] * 16, 0, "x"), (n + 6, [float("inf")] * 16, 0, "x"),
             (n + 7, vecs[0][:3], 0, "x"), (n + 8, vecs[0][:3], 0, "x"), (None, vecs[0], 0, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, rep string")
    ok = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab, _ in data[:n] + data[n + 7:n + 9]]
    links = defaultdict(set)
    for i, v, a in ok:
        for j, w, b in ok:
            if i != j and a == b and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98:
                links[i].add(j)

    def smallest(i):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        return min(seen)
    got = rows(embed_dedup.near_vectors(df), "vec_id")
    assert len(got) == len(data) and got[None].kept and got[None].n_links == 0
    for i, *_ in data[:-1]:
        assert (got[i].n_links, got[i].component_id) == (len(links[i]), smallest(i)), i
    assert sum(map(len, links.values())) > 20
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 64))
    y = x + 0.15 * rng.standard_normal((400, 64))
    cos = (x * y).sum(1) / np.linalg.norm(x, axis=1) / np.linalg.norm(y, axis=1)
    qy, _, _ = embed_dedup.encode(x)
    oy, _, f = embed_dedup.encode(y)
    est = np.diag(embed_dedup.estimates(qy, np.where(oy >= 0, 1.0, -1.0), f))
    assert abs((est - cos).mean()) < 0.002
    assert (est > cos - embed_dedup.margins(f, 64, 0.98) * np.sqrt(1 - cos ** 2) / np.sqrt(1 - 0.98 ** 2)).all()


# 3 -----------------------------------------------------------------------------------------

def shingle_set(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_groups(texts):
    s = {i: shingle_set(t) for i, t in texts}
    label = {i: i for i in s}
    todo = sorted(s)
    for i in todo:
        for j in todo:
            if i < j and s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                a, b = label[i], label[j]
                label = {k: min(a, b) if v in (a, b) else v for k, v in label.items()}
    return s, label


def test_near_duplicates_against_brute_force(spark, awkward, docs, empty, monkeypatch):
    got = rows(minhash.near_duplicates(docs))
    s, label = near_groups(list(enumerate(awkward)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == \
        {i: (len(s[i]), label[i], label[i] == i) for i in s}
    assert minhash.near_duplicates(empty).count() == 0
    rng = random.Random(5)
    base, family = words(120, 9).split(), []
    for _ in range(60):  # a chain of edits, cut into many small blocks
        base = list(base)
        base[rng.randrange(len(base))] = f"e{rng.randrange(10**6)}"
        family.append(" ".join(base))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)
    got = rows(minhash.near_duplicates(docs_of(spark, family)))
    _, label = near_groups(list(enumerate(family)))
    assert {i: r.component_id for i, r in got.items()} == label
    twice = docs_of(spark, ["a b c d e f"] * 2).unionByName(docs_of(spark, ["a b c d e f"])).collect()
    twice = spark.createDataFrame(twice + [(None, "a b c d e f", *twice[0][2:])], DOCS)
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in minhash.near_duplicates(twice).collect() if r.doc_id == 0) \
        == [(False, 0, True)] * 2


def stages_of(spark, group, work):
    """What ``work`` returns, and the number of stages that its jobs name."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    told = sc.statusTracker()
    return out, sum(len(told.getJobInfo(j).stageIds) for j in told.getJobIdsForGroup(group))


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(260, i) for i in range(200, 260)]
    links += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    links += links[::7] + [(b, a) for a, b in links[::5]]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    links += [(5, 5), (7, None), (None, 9), (None, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = [(r.node, r.component) for r in common.connected_components(df, "a", "b").collect()]
    assert sorted(got) == sorted((x, c) for x, c in label.items() if x != c)
    assert not common.connected_components(df.limit(0), "a", "b").count()


def test_components_take_few_exchanges(spark):
    star = spark.createDataFrame([(0, i) for i in range(1, 100)], "a long, b long")
    got, few = stages_of(spark, "star", lambda: common.connected_components(star, "a", "b"))
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    _, many = stages_of(spark, "chain", lambda: common.connected_components(chain, "a", "b"))
    assert got.count() == 99
    assert few < 20 and many < 110


def test_band_keys_move_once(spark):
    texts = [words(60, i % 20) + f" {i}" for i in range(60)]
    reps = minhash.signatures(docs_of(spark, texts)).withColumnRenamed("doc_id", "rep").localCheckpoint()
    got, n = stages_of(spark, "families", lambda: minhash.families(reps))
    assert {r.rep: r.family for r in got.collect()} == {i: i % 20 for i in range(60)}
    assert n < 40


def test_bit_counts_estimate_similarity():
    a = minhash.shingles(words(400, 1, 10**6))
    for share in (0.2, 0.5, 0.8):
        b = np.union1d(a[:int(len(a) * share)], minhash.shingles(words(200, 7, 10**6)))
        fa, fb = (minhash._fields(minhash.minima(x)) for x in (a, b))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(minhash.similarity(int((fa == fb).sum())) - true) < 0.15


# 4 -----------------------------------------------------------------------------------------

def test_packing_pieces_and_offsets(spark, awkward, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    ids = {i: lib.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(awkward)}
    got = packing.pack_documents(docs, path).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, want in ids.items():
        ps, at = sorted(pieces[i], key=lambda r: r.piece), 0
        assert len(ps) == -(-len(want) // 2048)
        for k, r in enumerate(ps):
            assert (r.piece, r.start) == (k, at) and (r.length == 2048 or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(map(len, ids.values()))
    assert len(seqs) <= -(-total // 2048) + 1
    assert packing.pack_documents(empty, path).count() == 0


def test_words_path_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, own = Tokenizer.from_file(path), packing.Words(path)
    assert own.short is not None
    for t in ["", " ", "a  b", "a \n b", "\n\n x", "x\n\n y", " lead", "trail  ", "it's  I'll\t\tx  \r\n z", "\x1c a \x85 b\xa0c",
              "½ ² 12x", "日本 語", "<|endoftext|> a"]:
        assert own.encode(t) == np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_local_search_empties_bins():
    bins = [[0], [1, 2], [3]]
    sizes = [9, 3, 3, 4]  # room 10: 3 moves next to 4 and 3
    out = packing.improve([list(b) for b in bins], sizes, 10)
    assert len(out) == 2 and sorted(i for b in out for i in b) == [0, 1, 2, 3]
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 80))]
        worst = [[i] for i in range(len(sizes))]
        out = packing.improve(worst, sizes, 100)
        assert sorted(i for b in out for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in out)


# 5 -----------------------------------------------------------------------------------------

def test_language_codes_on_held_out_rows(spark, sf_small, docs, empty):
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = langid.fit(d)
    got = rows(langid.identify(d, model))
    want = {r.doc_id: r.lang for r in d.collect()}
    held = [i for i in want if zlib.crc32(str(i).encode()) % 3 == 1]
    known = [i for i in held if got[i].lang_pred != "und"]
    assert np.mean([got[i].lang_pred == want[i] for i in known]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = rows(langid.identify(docs, model))
    assert {odd[i].lang_pred for i in (3, 4, 5, 16)} == {"und"} and odd[3].score == 0
    assert langid.identify(empty, model).count() == 0 and langid.fit(empty) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and not {3, 4, 5, 16} & {r.doc_id for r in kept.collect()}


def test_codewords_are_far_apart():
    for n in (2, 4, 5, 9, 30):
        c = langid.codewords(n)
        assert min((a != b).sum() for i, a in enumerate(c) for b in c[:i]) >= max(1, c.shape[1] // 4)


# 6 -----------------------------------------------------------------------------------------

def brute_measures(t):
    w = WORD.findall(t)
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_line_quality(awkward, docs, empty):
    rng = random.Random(4)
    texts = [t or "" for t in awkward] + [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(60)]
    for t in texts:
        assert quality.measures(t) == brute_measures(t)
    got = rows(quality.line_quality(docs))
    for i, t in enumerate(awkward):
        n, chars, sym, dup, rep = brute_measures(t or "")
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep)
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n) and not (r.base_failed and r.kept)
    prose = "\n".join(" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(9)) + "." for _ in range(8))
    junk = "\n".join(f"menu {i}" for i in range(30)) + "\n" + prose[:60] + "."
    assert [rows(quality.line_quality(docs_of(docs.sparkSession, [prose, junk])))[i].kept for i in (0, 1)] == [True, False]
    assert quality.line_quality(empty).count() == 0
    rules = quality.LineRules()
    assert quality.line_fault("Home | About | Contact | Help", rules) == "navigation"
    assert quality.line_fault("Accept all cookies", rules) == "boilerplate"
    assert quality.line_fault("no end here", rules) == "punctuation"
    assert quality.line_fault("An ordinary sentence that ends.", rules) is None
    assert quality.clean_lines("menu\n" + prose, rules)[0] == prose


# 7 -----------------------------------------------------------------------------------------

def brute_repeats(texts, length):
    seen, out = set(), {}
    for i, t in texts:
        b = (t or "").encode()
        m = [False] * len(b)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                m[p:p + length] = [True] * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, m) if not g)
        out[i] = (len(b), sum(m), sum(g and not (k and m[k - 1]) for k, g in enumerate(m)), hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_passages_against_brute_force(spark, awkward, docs, empty):
    rng = random.Random(8)
    passages = [words(40, 100 + i) for i in range(4)]
    texts = awkward + [" ".join(rng.choice(passages)[rng.randrange(60):] for _ in range(3)) for _ in range(25)] + ["Der " * 300]
    got = rows(suffix.measure_repeats(docs_of(spark, texts)))
    want = brute_repeats(list(enumerate(texts)), 100)
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want
    assert suffix.measure_repeats(empty).count() == 0
    out = suffix.remove_repeats(docs)
    assert out.columns == docs.columns
    texts_out = {r.doc_id: r.text for r in out.collect()}
    assert texts_out[3] is None and texts_out[1] == "" and texts_out[0] == awkward[0]
    with_null = docs.unionByName(spark.createDataFrame([(None, awkward[0], *[None] * 8)], DOCS))
    again = {r.doc_id: r.n_removed for r in suffix.measure_repeats(with_null).collect()}
    assert again[None] == 0 and again[0] == len(awkward[0])


def test_hot_key_of_different_segments_is_split(spark, awkward, monkeypatch):
    footer = "All rights reserved by the harbour office, printed from example.org/harbour/prints on a grey day of the season."
    texts = awkward + [words(30, 500 + i) + " " + footer[:60 + i % 50] + " " + words(25, 900 + i % 40) for i in range(60)]
    want = brute_repeats(list(enumerate(texts)), 100)
    docs = docs_of(spark, texts)
    largest = []
    for limit, rows_ in ((10**6, 600_000), (3000, 600_000), (0, 40)):
        monkeypatch.setattr(suffix, "MAX_SHARD", limit)
        monkeypatch.setattr(suffix, "COLLAPSE_ROWS", rows_)
        got = rows(suffix.measure_repeats(docs))
        assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want
        texts_of = suffix.shards(suffix._keyed(docs, "doc_id", "text")).selectExpr("h", "length(text) AS n").groupBy("h").sum("n")
        largest.append(max(r[1] or 0 for r in texts_of.collect()))
    assert largest[0] > 3000 >= largest[1] > largest[2] == 0


def test_induced_sorting_with_spilled_queues(monkeypatch):
    rng = random.Random(3)
    for limit in (4, 10**6):
        monkeypatch.setattr(induced, "QUEUE_ROWS", limit)
        monkeypatch.setattr(induced, "MAPPED_ROWS", limit)
        for _ in range(60):
            strings = [[rng.randint(1, rng.choice([1, 2, 5, 99])) for _ in range(rng.randrange(50))] for _ in range(rng.randint(1, 4))]
            text = np.array([x for s in strings for x in [*s, 0]], np.int64)
            group = np.array([i for i, s in enumerate(strings) for _ in range(len(s) + 1)], np.int64)
            with induced.Scratch() as scratch:
                got = induced.suffix_order(text, group, scratch).tolist()
            want, at = [], 0
            for s in strings:
                s = [*s, 0]
                want += [at + i for i in sorted(range(len(s)), key=lambda i: s[i:])]
                at += len(s)
            assert got == want


def test_reduced_strings_are_sorted_again_only_where_names_repeat(monkeypatch):
    rng = random.Random(4)
    sizes, induce = [], induced._induce
    monkeypatch.setattr(induced, "_induce", lambda text, *rest: sizes.append(len(text)) or induce(text, *rest))
    passage = [rng.randint(1, 9) for _ in range(400)]
    strings = [passage * 3] + [[rng.randint(1, 10**6) for _ in range(300)] for _ in range(20)]
    text = np.array([x for s in strings for x in [*s, 0]], np.int64)
    group = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
    want, at = [], 0
    for s in strings:
        s = [*s, 0]
        want += [at + i for i in sorted(range(len(s)), key=lambda i: s[i:])]
        at += len(s)
    steps = {}
    for direct in (0, 20, 10**6):  # recursion to the end, for a while, not at all
        monkeypatch.setattr(induced, "DIRECT", direct)
        sizes.clear()
        with induced.Scratch() as scratch:
            assert induced.suffix_order(text, group, scratch).tolist() == want
        steps[direct] = list(sizes)
    assert steps[10**6] == [len(text)] * 2
    assert len(steps[0]) > 4 and steps[0][1] < len(strings[0])  # the strings without repeats are left out


def test_shards_are_cut_at_key_bounds(monkeypatch):
    monkeypatch.setattr(suffix, "BATCH_SYMBOLS", 900)
    rng, calls, find = random.Random(5), [], suffix.later_windows
    monkeypatch.setattr(suffix, "later_windows", lambda text, n, h, length: calls.append(h.tolist()) or find(text, n, h, length))
    rows_, want = [], set()
    for key in range(40):
        body = bytes(rng.choices(range(65, 91), k=120))
        for d in range(rng.choice([1, 2, 3, 9])):
            rows_.append((key, d, key, 21, body, None, None))
            if d:
                want.add((d, key, key + 120))
    got = set()
    for step in (1, 7, 50, 1000):
        calls.clear()
        cols = [pa.array(c, k) for c, k in zip(zip(*rows_), suffix.SHARD_TYPES)]
        batch = pa.RecordBatch.from_arrays(cols, names=suffix.SHARD_NAMES)
        out = list(suffix.sort_shards(iter([batch.slice(a, step) for a in range(0, len(rows_), step)]), 100))
        got = [tuple(r.values()) for b in out for r in b.to_pylist()]
        assert len(got) == len(want) and set(got) == want
        assert sum(len(set(c)) for c in calls) == 40  # no key is in two calls
        assert all(len(set(c)) == 1 or 120 * len(c) <= 900 for c in calls) and len(calls) < 30


def test_rows_of_many_documents_go_on_together(spark, monkeypatch):
    footer = words(40, 77)
    texts = [words(20, 300 + i) + " " + footer + " " + words(20, 600 + i) for i in range(60)]
    sent = []
    make = suffix._shard_rows
    docs = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts), pa.array(
        [[{"h": i, "p": 0, "n": 20, "kind": suffix.SORT}, {"h": 0, "p": 50, "n": 20, "kind": suffix.COPY}] for i in range(60)],
        pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64()), ("n", pa.int32()), ("kind", pa.int32())])))], names=["d", "text", "segs"])
    monkeypatch.setattr(suffix, "_shard_rows", lambda *a, **k: sent.append(len(a[0])) or make(*a, **k))
    out = pa.Table.from_batches(suffix.cut_texts(iter([docs]), 100)).to_pylist()
    assert sent == [60, 60]
    assert [x["text"] for x in out[:60]] == [t.encode()[:119] for t in texts]
    assert [(x["d"], x["cuts"]) for x in out[60:]] == [(i, [{"a": 50, "b": 169}]) for i in range(60)]


# 8 -----------------------------------------------------------------------------------------

def test_layout_rendering(spark):
    page = ("<!doctype html><title>no</title><style>p{}</style><p>a <b>b</b>\n c<p>second<br>line<ul><li>x<li>y<ol><li>1<li>2"
            "</ol></ul><table><tr><th>name<th>n<tr><td>longer one<td>5</table>after &amp; more<pre>a  b\n  c</pre>"
            "<div hidden>no</div><span style='display: none'>no</span><script>if(a<b)no()</script>t<hr>u<!-- no -->")
    text = html_layout.extract(page)
    assert text == ("a b c\n\nsecond\nline\n\n- x\n- y\n  1. 1\n  2. 2\n\nname        n\nlonger one  5\n\nafter & more\n\n"
                    "a  b\n  c\n\nt\nu")
    deep = "<div>" * 20000 + "x"
    df = spark.createDataFrame([(1, page, "u"), (2, None, "u"), (3, "", "u"), (4, deep, "u"), (5, "</td></p><td>q", "u"), (None, "z<", "u")],
                               "page_id long, html string, text string")
    got = rows(html_layout.extract_pages(df), "page_id")
    assert (got[2].text, got[3].text, got[4].text, got[5].text, got[None].text) == ("", "", "x", "q", "z<")
    assert html_layout.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>t</title><meta charset=x><p>seen</p>more", "seen\n\nmore"),
    ("<head><style>p{}</style>bare text", "bare text"),
    ("<head><noscript><img alt=no></noscript><title>t</title></head><body>b", "b"),
    ("<table><td>x<td>y</table>", "x  y"),
    ("<table><tbody><td>x</tbody><tr><td>y</table>", "x\ny"),
    ("<table><form><tr><td>a<td>b</form></table>", "a  b"),
    ("<table><center>note</center><tr><td>a</table>z", "note\na\n\nz"),
    ("<table>loose<tr><td>a</table>", "loose\na"),
    ("<table><tr><font>in row</font><td>a</table>", "in row\na"),
    ("<svg><text>label</text></svg> <span aria-hidden=true>icon</span> <math><mi>k</mi></math>", "label icon k"),
    ("<table><tr><td>one<br>two<td>x</table>", "one  x\ntwo"),
])
def test_layout_keeps_text_of_pages_with_omitted_tags(page, text):
    assert html_layout.extract(page) == text


def test_layout_keeps_all_visible_words(spark, sf_small):
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.said = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("style", "script", "title")

        def handle_endtag(self, tag):
            self.skip -= tag in ("style", "script", "title")

        def handle_data(self, data):
            if not self.skip:
                self.said.append(data)
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    out = rows(html_layout.extract_pages(pages), "page_id")
    for r in pages.collect():
        p = Plain()
        p.feed(r.html)
        strip = re.compile(r"[\s\-]+")
        assert strip.sub("", out[r.page_id].text) == strip.sub("", "".join(p.said))


# 9 -----------------------------------------------------------------------------------------

def test_rank_bpe_equals_the_library(awkward, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = rows(bpe_rank.encode_texts(docs, path))
    digests = rows(bpe_rank.encode_digests(docs, path))
    for i, t in enumerate(awkward):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        r = got[i]
        assert r.n_tokens == len(ids) and r.ids == " ".join(map(str, ids))
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
        assert digests[i].ids_sha256 == hashlib.sha256(r.ids.encode()).hexdigest()
    assert bpe_rank.encode_texts(empty, path).count() == 0
    bpe = bpe_rank.load(path)
    for t in ["ΑΣ ΟΔΟΣ", "İstanbul ǅ ﬁ", "á é", "<|startoftext|>Hi<|endoftext|> x<|endoftext", "DON'T we'Re", "𝔄😀👍🏽\x1c\x85a",
              "it's 12३४ ½ x²", "ͅΙ ŉ's ẞ Ω"]:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t) == (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False), len(ids)), t


# 10 ----------------------------------------------------------------------------------------

def brute_lines(texts):
    seen, out = set(), {}
    for i, t in texts:
        ls = t.split("\n") if t is not None else []
        gone = set()
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if not "".join(w).strip(" \t\r"):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = (len(ls), len(gone), None if t is None else "\n".join(x for p, x in enumerate(ls) if p not in gone))
    return out


def test_line_windows_against_brute_force(spark, awkward, docs, empty):
    rng = random.Random(6)
    texts = awkward + ["\n".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(25)]
    got = rows(lines.dedup_lines(docs_of(spark, texts)))
    assert {i: (r._n_lines, r._n_removed, r.text) for i, r in got.items()} == brute_lines(list(enumerate(texts)))
    out = lines.dedup_lines(docs)
    assert set(docs.columns) <= set(out.columns) and lines.dedup_lines(empty).count() == 0


def test_line_windows_plan_has_no_python(spark, docs):
    plan = lines.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_documents_are_told_apart_by_id_and_text(spark):
    shared = "\n".join(words(9, 700 + i) for i in range(6))
    other = "\n".join(words(9, 800 + i) for i in range(14))
    first, second = shared + "\n" + words(20, 1), other + "\n" + shared
    data = [(None, first), (None, second), (None, other.upper()), (7, first.lower()[::-1]), (7, other[::-1] + "\n" + first)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    key = [(i, hashlib.md5(t.encode()).digest(), t) for i, t in data]
    order = sorted(key, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    want = {order[i][2]: v for i, v in brute_lines([(i, k[2]) for i, k in enumerate(order)]).items()}
    got = lines.dedup_lines(df.withColumn("whole", df.text)).collect()
    assert {r.whole: (r._n_lines, r._n_removed, r.text) for r in got} == want and len(got) == len(data)
    texts = {i: t for i, (_, t) in enumerate(data[:3])}
    kept = suffix.measure_repeats(df.filter("doc_id is null")).collect()
    brutes = [sorted(brute_repeats([(i, texts[i]) for i in p], 100).values()) for p in ((0, 1, 2), (1, 0, 2))]
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in kept) in brutes
    assert {r.doc_id for r in kept} == {None}


# pipeline ----------------------------------------------------------------------------------

def test_pipeline_against_brute_force(spark, awkward):
    base = "doc_id long, text string, lang string, source string, n_chars long"
    texts = awkward + [words(60, 300 + i) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], base)
    stage = dict(corpus_pipeline.STAGES)
    one = stage["language_id"](spark, docs, "").collect()
    assert {r.doc_id for r in one} == {i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))}
    two = {r.doc_id: r.text for r in stage["line_dedup"](spark, spark.createDataFrame(one, base), "").collect()}
    assert two == {i: v[2] for i, v in brute_lines([(r.doc_id, r.text) for r in sorted(one)]).items()}
    made = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in two.items()], base)
    three = stage["near_dedup"](spark, made, "").collect()
    _, label = near_groups(sorted(two.items()))
    assert {r.doc_id for r in three} == {i for i, v in label.items() if i == v}
    made = spark.createDataFrame(three, base)
    four = stage["passage_dedup"](spark, made, "")
    assert four.columns == docs.columns
    want = brute_repeats(sorted((r.doc_id, r.text) for r in three), 100)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][3] for r in four.collect() if r.text.isascii())
    five = stage["packing"](spark, four, "").collect()
    assert {r.doc_id for r in five} == {r.doc_id for r in three}


def test_pipeline_runs_on_the_small_tables(spark, sf_small):
    got = corpus_pipeline.run(spark, sf_small)
    assert got.count() > 100 and "sequence_id" in got.columns
