"""Every operator against a plain version, over edge cases, empty and null tables."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from ferrovia.llm import (
    common,
    decontaminate,
    induced_sort,
    language_id,
    odd_sketch,
    packing,
    pitman_yor,
    preference,
    quality_rules,
    queries,
    secrets,
    suffix_dedup,
    token_counts,
    token_sums,
)
from ferrovia.session import checkpoint_root, path_exists
from tests.llm import brute
from tests.llm.conftest import SF

WORD_BPE = queries.tokenizer("word_bpe_49k.json")
BYTE_BPE = queries.tokenizer("byte_bpe_50k.json")
ITEMS = [(1, " ".join(f"shared{i}" for i in range(20))), (2, "three LITTLE words!"), (2, "three little words"),
         (None, "shared5 shared6"), (3, None), (4, "... ---"), (5, "not anywhere in these texts at all")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id int, text string")


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


OPERATORS = {
    "quality": lambda d, s: quality_rules.clean_lines(d),
    "benchmark": lambda d, s: decontaminate.contamination(d, s.createDataFrame(ITEMS, "item_id int, text string")),
    "packing": lambda d, s: packing.pack(d, WORD_BPE),
    "secrets": lambda d, s: secrets.find_secrets(d),
    "near": lambda d, s: odd_sketch.near_duplicates(d),
    "tokens": lambda d, s: token_counts.token_counts(d, BYTE_BPE),
    "scores": lambda d, s: pitman_yor.score(d),
    "repeats": lambda d, s: suffix_dedup.without_repeats(d),
    "language": lambda d, s: language_id.identify(d),
    "preference": lambda d, s: preference.score(d, s.createDataFrame([], "doc_id long, quality int, toxic int")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_null_tables(spark, no_docs, null_docs, name):
    run = OPERATORS[name]
    assert run(no_docs, spark).collect() == []
    got = run(null_docs, spark).collect()
    # Two rows without anything: two results (packed: two end tokens).
    assert len(got) == 2 and {r["doc_id"] for r in got} == {None}


def test_quality_rules(docs, rows):
    out = quality_rules.clean_lines(docs)
    got = tuples(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == Counter((i, *brute.quality(t)) for i, t, _ in rows)
    assert out.where("kept and base_failed").isEmpty()


def test_lines_are_removed(spark):
    text = "\n".join(["A plain line of words that stays.", "home | about | contact | help", "this site uses cookies to work",
                      "WHAT!! A!! LOUD!! LINE!!", "a*** b### c$$$ d%%% e&&&", "Another plain line, with enough words."])
    row = quality_rules.clean_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["clean_text"] == "A plain line of words that stays.\nAnother plain line, with enough words."
    assert not row["kept"]  # more than 30 % lost
    long = "A plain line of words that stays. " * 30 + "\nhome | about | contact"
    row = quality_rules.clean_lines(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert row["base_failed"] and "|" not in row["clean_text"]


def test_decontamination(docs, rows, items):
    out = decontaminate.contamination(docs, items)
    want = Counter((i, *brute.benchmark_hits(t, [("" if k is None else k, x) for k, x in ITEMS])[:2]) for i, t, _ in rows)
    assert tuples(out.select("doc_id", "n_words", "n_hit")) == want
    hit = {r["doc_id"]: r["item_ids"] for r in out.collect()}
    assert hit[900_010] == ["", "1"] and hit[900_006] == ["2"]
    # Blocks of the benchmark give what one block gives.
    assert tuples(decontaminate.contamination(docs, items, block_bytes=60).select("doc_id", "n_words", "n_hit")) == want


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(1)
    for _ in range(200):
        m = rng.randint(1, 6)
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        patterns = list({tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(m)) for _ in range(5)})
        want = {(i, p) for p in patterns for i in range(len(text) - m + 1) if tuple(text[i:i + m]) == p}
        assert set(decontaminate.WuManber(patterns).find(text)) == want


def test_packing(docs, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORD_BPE)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, WORD_BPE).collect():
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(brute.packed_ids(tokenizer, t))
    for i, texts in want.items():
        # Rows that repeat an id are packed each for itself.
        assert b"".join(bytes(p["ids"]) for p in sorted(pieces[i], key=lambda p: p["start"])).__len__() == sum(map(len, texts))
        for p in pieces[i]:
            assert bytes(p["ids"]) == texts[0][4 * p["start"]:4 * (p["start"] + p["length"])]
            assert p["doc_tokens"] * 4 == len(texts[0])
    for w in windows.values():
        w.sort(key=lambda p: p["offset"])
        total = 0
        for p in w:
            assert p["offset"] == total
            total += p["length"]
        assert total == packing.WINDOW or total & (total - 1) == 0


def test_word_ids_equal_the_library(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = [t or "" for _, t, _ in rows] + ["Straße ÉCOLE ñandú don't 's I'LL x<|endoftext|>y é ẞİ \x1c\x1f ª 12ab"]
    for text, ids in zip(texts, packing.WordIds(WORD_BPE).encode(texts), strict=True):
        assert ids + b"\x01\0\0\0" == brute.packed_ids(tokenizer, text)


def test_sum_of_squares_level():
    packer = packing.SumOfSquares(10)
    assert packer.level_for(4) == 0
    list(packer.add("a", b"\0" * 16))
    full = list(packer.add("b", b"\0" * 24))  # 4 + 6 fill a window
    assert [[(p[0], len(p[2]) // 4) for p in w] for w in full] == [[("a", 4), ("b", 6)]]
    rng = random.Random(2)
    for _ in range(400):  # the choice minimises the sum of squares
        packer.count[1:10] = [rng.randint(0, 4) for _ in range(9)]
        size = rng.randint(1, 9)

        def cost(h):
            n = packer.count.copy()
            n[h] -= h > 0
            n[h + size] += 1
            return int((n[1:10] ** 2).sum())

        open_levels = [0] + [h for h in range(1, 11 - size) if packer.count[h]]
        assert cost(packer.level_for(size)) == min(map(cost, open_levels))


def test_secrets(docs, rows):
    got = defaultdict(list)
    for r in secrets.find_secrets(docs).collect():
        got[r["doc_id"]].append([f"{s['kind']}:{s['start']}:{s['stop']}" for s in r["spans"]])
    for i, t, _ in rows:
        for spans in got[i]:
            assert [s for s in spans if not s.startswith("random")] == brute.base_secret_spans(t)


def test_battery_tells_random_from_words():
    rng = random.Random(4)
    keys = ["".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(40)) for _ in range(200)]
    passed = sum(secrets.combined(secrets.battery(k, "base62")) > 0.01 for k in keys)
    assert passed >= 190
    words = ["thebrownfoxjumpedovertheLazydogandranaway", "aaaaaaaaaaaaaaaaaaaabbbbbbbbbbbbbbbbbbbb"]
    assert all(secrets.combined(secrets.battery(w, "base62")) < 0.01 for w in words)


def test_planted_keys_are_found(spark):
    rng = random.Random(5)
    plain = " ".join(rng.choice(["the", "river", "stone", "under", "Bridges", "water", "longer"]) for _ in range(300))
    rows = [(k, f"{plain} {''.join(rng.choice(secrets.ALPHABETS['base62']) for _ in range(40))} {plain}") for k in range(60)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(any(s["kind"] == "random" for s in r["spans"]) for r in found) >= 50
    assert all(len(r["spans"]) <= 1 for r in found)
    assert secrets.redact("abcdefgh", [(1, 3), (2, 5)]) == "a[SECRET]fgh"


def test_candidates_after_a_name_and_of_any_length():
    rng = random.Random(6)
    key = "".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(5000))
    for text, want in ((f"AWS_SECRET_ACCESS_KEY={key[:40]}", key[:40]), (f"a sig={key[:28]}&x=1", key[:28]), (f"b {key} c", key),
                       (f"k={key[:42]}==", key[:42] + "=="), (f"{key[:30]}=b", key[:30])):
        assert want in [text[a:b] for found in secrets.candidates(text) for a, b, *_ in found]


def test_parts_of_paths_and_runs_without_an_alphabet():
    rng = random.Random(12)
    key = "".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(40))
    text = f"see /var/lib/{key}/data +-------------------- and {'-' * 40} {key[:10]}/{key[10:]}=="
    found = list(secrets.candidates(text))
    assert [[text[a:b] for a, b, *_ in f] for f in found] == [
        [f"/var/lib/{key}/data", key], ["+" + "-" * 20], ["-" * 40], [f"{key[:10]}/{key[10:]}==", f"{key[10:]}=="]]
    assert found[1][0][-1] == 0 and found[2][0][-1] == 0
    at = found[0][1]
    # A part of an accepted run is not listed beside it.
    assert secrets.accepted_spans(text, {at[2:4]: at[4]}) == [(at[0], at[1], "random")]
    whole = found[3][0]
    assert secrets.accepted_spans(text, {f[2:4]: 0 for f in found[3]})[-1] == (whole[0], whole[1], "random")


def test_planted_keys_of_every_encoding_against_names_and_paths(spark):
    """Recall and precision where no base pattern helps: keys of each alphabet, in
    texts that also hold paths, slugs and camel-case names with numbers."""
    rng = random.Random(13)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    vocabulary = sorted({w.lower() for t in texts for w in t.split() if w.isascii() and w.isalpha() and len(w) > 2})
    word = lambda: rng.choice(vocabulary)
    number = lambda: str(rng.randrange(300))
    rows, planted, names = [], {}, set()
    # Hexadecimal runs are base spans.  Plain numbers look as random as keys of
    # digits do: such keys are accepted only where the numbers of the texts differ.
    encodings = [e for e in secrets.ALPHABETS if e not in ("hex", "decimal")]
    for k in range(len(encodings) * 30):
        n = rng.choice((32, 40, 64))
        key = "".join(rng.choice(secrets.ALPHABETS[encodings[k % len(encodings)]]) for _ in range(n)).strip("-_+/") or "x"
        made = ["/".join([word(), word(), word() + number(), word(), word()]), "-".join([word(), word(), number(), word(), word()]),
                "".join([word().title() + (number() if rng.random() < 0.3 else "") for _ in range(5)]),
                "".join(word() for _ in range(5)), "_".join([word().upper(), word().upper(), number(), word().upper()])]
        head, tail = rng.choice(texts), rng.choice(texts)
        rows.append((k, f"{head} {' , '.join(made)} | {key} | {tail}"))
        planted[k] = key
        names.update(made)
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    text = dict(rows)
    hits, wrong, by = Counter(), 0, Counter()
    for r in found:
        got = [text[r["doc_id"]][s["start"]:s["stop"]] for s in r["spans"] if s["kind"] == "random"]
        e = encodings[r["doc_id"] % len(encodings)]
        by[e] += 1
        hits[e] += any(planted[r["doc_id"]] == g.strip("-_+/") for g in got)
        wrong += sum(g in names for g in got)
    assert sum(hits.values()) >= 0.9 * sum(by.values()), hits
    assert wrong <= 0.02 * sum(hits.values()), wrong
    assert min(hits.values()) >= 15, hits


def test_decoys_come_from_whole_texts_for_every_encoding(spark):
    import numpy as np
    rng = random.Random(8)
    words = "".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(30))
    text = "12345 " * 200 + f"{words[:9]} {words[9:20]} Plain words 2024 " * 800
    wanted = [(e, b) for e in secrets.ALPHABETS for b in (8, 11, 14, 20)]
    n = Counter()
    for r in secrets.decoys(spark.createDataFrame([(text,)] * 3, "text string").coalesce(1), wanted).collect():
        n[r["encoding"], r["band"]] += r["n"]
    words = secrets.plain(text)
    assert len(words) == 200 + 5 * 800 and words == text.encode().split()
    assert secrets.numbered(words)[1::3] == words[1::3]
    for e, b in wanted:
        data = secrets.written(3 * words, e)
        assert set(data.decode()) <= set(secrets.ALPHABETS[e])
        assert n[e, b] == len(data) // secrets.lengths_of(b)
    assert set(n) == set(wanted)
    for e in secrets.ALPHABETS:  # all at once as one by one
        for size in (20, 33, 64, 200):
            made = ["".join(rng.choice(secrets.ALPHABETS[e][:rng.choice((1, 9, 99))]) for _ in range(size)) for _ in range(60)]
            got = secrets.levels(np.array([list(s.encode()) for s in made], np.uint8), e)
            assert got.tolist() == [secrets.level_of(secrets.combined(secrets.battery(s, e))) for s in made]


def test_long_and_named_keys_are_found(spark):
    rng = random.Random(9)
    plain = "this text has only ordinary words of a plain language and nothing else to see here at all " * 8
    key = lambda n: "".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(n))
    rows = [(k, f"{plain} sig={key(60)}&x {plain} {key(3000)} {plain}") for k in range(40)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    lengths = Counter(s["stop"] - s["start"] for r in found for s in r["spans"] if s["kind"] == "random")
    assert lengths[60] >= 36 and lengths[3000] >= 36


def test_language_sample_is_bounded_with_null_and_repeated_ids(spark):
    rows = [(None, f"text number {k} of no id", "en") for k in range(6000)] + [(7, "the same row", "fr")] * 4000
    rows += [(8, f"the same id, another text {k}", "de") for k in range(6000)] + [(k, f"un texte {k}", "fr") for k in range(50)]
    got = Counter(r["lang"] for r in language_id.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert 1300 < got["en"] < 1700 and 1300 < got["de"] < 1700 and got["fr"] <= 51


def test_near_duplicates(docs, rows):
    want = brute.components([(i, t) for i, t, _ in rows if i is not None])
    got = odd_sketch.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] > 0
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]


def test_chains_and_crowds_of_near_copies(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows, now = [], list(words)
    for k in range(40):  # each links with its neighbours, the ends are far apart
        now[3 * k % 120] = f"new{k}"
        rows.append((1000 - k, " ".join(now)))
    for k in range(150):  # a crowd around one text
        copy = list(words)
        copy[rng.randrange(120)] = f"other{k}"
        rows.append((2000 + k, " ".join(copy)))
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute.components(rows).items()}


def test_near_copies_with_text_ids(spark):
    rng = random.Random(8)
    rows = []
    for family in range(12):  # copies that differ from each other about as much as the limit allows
        words = [f"w{rng.randrange(10_000)}" for _ in range(200)]
        for k in range(8):
            copy = list(words)
            for _ in range(rng.randrange(1, 7)):
                copy[rng.randrange(200)] = f"new{rng.randrange(10_000)}"
            rows.append((f"doc-{family:02d}-{k}", " ".join(copy)))
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(
        spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute.components(rows).items()}


def test_bound_refuses_no_similar_pair(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    rows, similar = [], []
    for size in (1, 4, 60, 400, 3000, 20_000):
        for _ in range(40):
            union = odd_sketch.mixed(rng.integers(0, 2**63, size + size // 3, np.uint64))
            in_a, in_b = rng.random(len(union)) < 0.9, rng.random(len(union)) < 0.9
            in_a[0] = in_b[0] = True
            a, b = np.unique(union[in_a]), np.unique(union[in_b])
            both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            similar.append(100 * both >= odd_sketch.SIMILARITY * either)
            rows.append((len(a), len(b), odd_sketch.parities(a).tolist(), odd_sketch.parities(b).tolist()))
        other = np.unique(odd_sketch.mixed(rng.integers(0, 2**63, len(a), np.uint64)))
        similar.append(False)
        rows.append((len(a), len(other), odd_sketch.parities(a).tolist(), odd_sketch.parities(other).tolist()))
    df = spark.createDataFrame(rows, "na long, nb long, fa array<long>, fb array<long>").coalesce(1)
    may = [r["may"] for r in df.select(odd_sketch.possible(*[F.col(c) for c in ("na", "nb", "fa", "fb")]).alias("may")).collect()]
    assert 40 < sum(similar) < 240 and all(m for m, s in zip(may, similar, strict=True) if s)
    assert sum(may) < len(may) - 5  # and it does refuse


def test_scratch_tables_of_near_copies_go(spark, docs, tmp_path, monkeypatch):
    made = []
    keep = odd_sketch.stored

    def noted(df, name):
        made.append(keep(df, name))
        return made[-1]

    monkeypatch.setattr(odd_sketch, "stored", noted)
    found = odd_sketch.near_duplicates(docs)
    found.write.parquet(f"{tmp_path}/found")
    common.drop_stored(found)
    assert made and not any(path_exists(spark, p) for t in made for p in t._stored_paths)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast_by_size(spark):
    """Every table is too large to be broadcast unless the code asks for it."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_that_may_be_among_ids(spark, kind):
    rows = spark.range(20_000).selectExpr(f"cast(id as {kind}) as doc_id", "'x' as text").unionByName(
        spark.createDataFrame([(None, "no id")], f"doc_id {kind}, text string"))
    ids = rows.where("cast(doc_id as long) % 100 = 7").select("doc_id")
    maybe, sure = [[r["doc_id"] for r in common.maybe_among(rows, "doc_id", ids, how).collect()]
                   for how in ("left_semi", "left_anti")]
    assert {r["doc_id"] for r in ids.collect()} <= set(maybe) and len(maybe) < 210
    assert len(maybe) + len(sure) == 20_001 and None in sure and not set(maybe) & set(sure)
    assert common.maybe_among(rows, "doc_id", ids.where("false")).isEmpty()


def test_only_texts_of_candidates_are_shuffled(spark, docs, monkeypatch, no_broadcast_by_size):
    plans = {}
    keep = odd_sketch.stored

    def noted(df, name):
        if name in ("near-sets", "near-known"):
            plans[name] = _plan(df)
        return keep(df, name)

    monkeypatch.setattr(odd_sketch, "stored", noted)
    odd_sketch.near_duplicates(docs)
    assert "near-sets" in plans and all("BroadcastHashJoin" in p and "LeftSemi" in p for p in plans.values())


def test_texts_that_stay_once_are_not_shuffled(spark, no_broadcast_by_size):
    import corpus_pipeline
    text = "one two three four five six seven eight nine ten"
    rows = [(k, f"{text} {k} {k + 1} {k + 2} {k + 3} {k + 4}") for k in range(20)]
    rows += [(30, "twice " * 9), (30, "twice " * 9), (31, rows[4][1]), (31, rows[4][1]), (32, rows[5][1]), (None, text), (None, text), (33, None)]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == [*range(20), 30, 33]
    assert out.where("doc_id is null").count() == 2
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_odd_sketch_estimates():
    import numpy as np
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    for share in (0.75, 0.9):
        m = int(1000 * 2 * share / (1 + share))
        b = np.concatenate([a[:m], rng.integers(0, 2**63, 1000 - m).astype(np.uint64)])
        x = odd_sketch.odd_sketches(odd_sketch.min_hashes([np.unique(a), np.unique(b)]))
        differ = sum(bin(int(v) & (2**64 - 1)).count("1") for v in x[0] ^ x[1])
        est = 1 + odd_sketch.BITS / (4 * odd_sketch.SAMPLES) * math.log(1 - 2 * differ / odd_sketch.BITS)
        assert abs(est - share) < 0.15


def test_gate_passes_pairs_at_the_limit():
    import numpy as np
    rng = np.random.default_rng(11)
    n, lost = 5000, 0
    for _ in range(20):  # pairs of similarity 0.75: samples that differ toggle two random bits
        toggles = 2 * rng.binomial(odd_sketch.SAMPLES, 0.25, n)
        at = np.repeat(np.arange(n), toggles) * odd_sketch.BITS + rng.integers(0, odd_sketch.BITS, toggles.sum())
        differ = (np.bincount(at, minlength=n * odd_sketch.BITS) & 1).reshape(n, -1).sum(axis=1)
        estimate = 1 + odd_sketch.BITS / (4 * odd_sketch.SAMPLES) * np.log(np.maximum(1e-9, 1 - 2 * differ / odd_sketch.BITS))
        lost += int((estimate < odd_sketch.LEAST_ESTIMATE).sum())
    assert lost == 0


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = Counter((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert tuples(token_counts.token_counts(docs, BYTE_BPE).select("doc_id", "n_bytes", "n_tokens")) == want


def test_pre_tokens_by_plain_classes():
    rng = random.Random(5)
    some = [*map(chr, [*range(9, 14), 28, 31, *range(32, 127), 0x85, 0xa0, 0xb2, 0xe9, 0x301, 0x660, 0x2028, 0x2160, 0x3000,
                       0x4e2d, 0xffff, 0x10400, 0x1d7ce, 0x1f600]), "'s", "'ll", " ", "  "]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [f" a{c} 1{c}{c} " for c in map(chr, [*range(0xd800), *range(0xe000, 0x10000)])]
    assert all(token_counts.pieces_of(t) == token_counts._PATTERN.findall(t) for t in texts)


@pytest.mark.parametrize("decoded", [False, True])
def test_frequent_tokens_of_any_length_are_broadcast(spark, monkeypatch, decoded):
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: (sent.append(value), send(self, value))[1])
    long = "é" * 200
    table = spark.createDataFrame([(i, f"{long} a {long} w{i}") for i in range(40)], "doc_id long, text string").repartition(2)
    split = str.split if decoded else (lambda t: t.encode().split())
    values = token_sums.frequencies(table.withColumn("counts", F.lit(True)), split).withColumn("size", F.octet_length("token").cast("long"))
    out = token_sums.document_sums(table, split, values, {"size": "long"}, hot_share=10, decoded=decoded)
    assert tuples(out.select("doc_id", "n_tokens", "size")) == Counter((i, 4, 801 + len(f"w{i}")) for i in range(40))
    tokens, digests = sent[-1]
    assert set(tokens) == {b"a"} and set(digests) == {hashlib.sha256(long.encode()).digest()}


def test_scores(docs, rows):
    got = sorted(pitman_yor.score(docs).collect(), key=lambda r: (r["doc_id"] or -1, r["base_score"]))
    want = sorted(zip((i for i, _, _ in rows), brute.unigram_base([(i, t) for i, t, _ in rows]), strict=True),
                  key=lambda x: (x[0] or -1, x[1][4]))
    for r, (i, (_, n, known, train, base)) in zip(got, want, strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, n, known, train)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def test_context_probabilities_sum_to_one():
    import numpy as np
    classes = {b"a": 0, b"b": 1, b"": 2}
    keys = [np.empty(0, np.int64)] * 3 + [np.array([((4 << 24 | 4 << 12 | 4) << 12) | 0, ((4 << 24 | 4 << 12 | 0) << 12) | 1])]
    model = pitman_yor.Contexts(classes, [(k, np.full(len(k), 7.0)) for k in keys])
    model.sample(np.random.default_rng(1), 3, 2)
    total = sum(10 ** model.log10_probs([[w]])[0] for w in (b"a", b"b", b"", b"rare"))
    assert math.isclose(total, 1, rel_tol=1e-9)
    after = sum(10 ** (model.log10_probs([[b"a", w]])[0] - model.log10_probs([[b"a"]])[0]) for w in (b"a", b"b", b"", b"rare"))
    assert math.isclose(after, 1, rel_tol=1e-9)


def test_scores_beat_the_base_on_held_out_text(spark):
    r = queries.QUERIES["op1_pitman_yor"](spark, SF).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_ordinary_words_are_learned_in_context(spark):
    # 2,000 pairs of words, each word in about one of 6,000 tokens, and one word that is everywhere.
    rng = random.Random(4)
    train = [(k, " ".join(f"left{i} right{i} the" for i in rng.sample(range(2000), 20))) for k in range(1200)]
    asked = [(2000 + i, f"the left{i} right{i}") for i in range(50)] + [(3000 + i, f"the left{i} right{i + 50}") for i in range(50)]
    docs = spark.createDataFrame(train + asked + asked[:1], "doc_id long, text string")
    got = pitman_yor.score(docs, docs["doc_id"] >= 2000).collect()
    assert len(got) == 1301
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(score[2000 + i] > score[3000 + i] + 1 for i in range(50))


def test_word_hashes_follow_the_words():
    texts = ["Ab  cd\tab", "", " ", "x" * 70 + "y ab", "x" * 6 + "y" + "x" * 64]
    got, sizes = pitman_yor.word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in pitman_yor.folded_words(t)]
    assert sizes.tolist() == [len(t.split()) for t in texts]
    assert len(got) == len(words) and len(set(got.tolist())) == len(set(words))
    assert len(set(zip(got.tolist(), words, strict=True))) == len(set(words))


def test_shard_probabilities_sum_to_one(spark):
    import numpy as np
    train = ["a b c a b d", "a b c", "c a b e e", "a"]
    asked = [f"a b {w}" for w in "abcdef"] + ["a b"]
    docs = spark.createDataFrame([(k, t, k < len(train)) for k, t in enumerate(train + asked)], "k long, text string, counts boolean")
    model = pitman_yor.Shard(pitman_yor.dealt(docs.coalesce(1), np.empty(0, np.uint64), 1).toArrow(), np.empty(0, np.uint64))
    state = model.sampled(np.random.default_rng(1), [None] + [(np.empty(0),) * 2] * 3, np.full(len(model.words), 1 / 7), 3, 1)[0]
    p = model.probabilities(*state, model.totals(*state), np.full(len(model.words), 1 / 7))[3][model.parent[4]]
    # The third symbol of each text asked: a to f and the end, all of the seven.
    at = [np.flatnonzero(model.text == len(train) + i)[2] for i in range(7)]
    assert math.isclose(p[at].sum(), 1, rel_tol=1e-9)


def test_occurrences_are_gathered_by_shard(spark):
    import numpy as np
    docs = spark.createDataFrame([(i % 40, " ".join(f"w{(i % 40) * j % 97}" for j in range(200)), i % 40 > 3) for i in range(160)],
                                 "k long, text string, counts boolean").repartition(4)
    none = np.empty(0, np.uint64)
    dealt = pitman_yor.dealt(docs, none, 3).localCheckpoint()

    def by_shard(table):
        for n in range(3):
            rows, keys, counts, number = pitman_yor.pieces(table.filter(pc.equal(table["shard"], n)))
            yield Counter(map(tuple, np.vstack([rows, keys[number].view(np.uint64), counts[number]]).T.tolist()))

    few, large = dealt.toArrow(), pitman_yor.gathered(dealt).toArrow()
    assert list(by_shard(few)) == list(by_shard(large)) and sum(by_shard(large), Counter()).total() == 160 * 201
    assert len(large) == 3 < len(few) and large.nbytes < 0.6 * few.nbytes
    assert sum(len(pitman_yor.pieces(large.slice(i, 1))[1]) for i in range(3)) <= 3 * 40     # a text is named once


def test_squeezed_numbers():
    import numpy as np
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        for n in (0, 1, 1000):
            x = np.arange(n).astype(kind) * kind(251)
            assert pitman_yor.restored(pitman_yor.squeezed(x), kind).tolist() == x.tolist()


def test_rounds_leave_no_tables(spark):
    root = checkpoint_root(spark).removeprefix("file://")
    kept = lambda: sorted(n.rsplit("-", 1)[0] for n in os.listdir(root) if n.startswith("py-"))
    before = Counter(kept())
    scored = pitman_yor.score(spark.createDataFrame([(i, f"a b c {i % 3}") for i in range(30)], "doc_id long, text string"))
    # what the result reads; the occurrences and the rounds' tables have gone
    assert Counter(kept()) - before == Counter({"py-words": 1, "py-scores": 1})
    assert scored.count() == 30


def test_repeats(docs, rows):
    short = [(i, t) for i, t, _ in rows if len(t or "") < 60_000]
    some = docs.where(F.length(F.coalesce("text", F.lit(""))) < 60_000)
    removed = F.aggregate("removed", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    got = lambda: tuples(suffix_dedup.without_repeats(some).select(
        "doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256)))
    want = Counter((i, *r) for (i, _), r in zip(short, brute.removed_bytes([t for _, t in short]), strict=True))
    assert got() == want
    crowd, suffix_dedup.CROWD = suffix_dedup.CROWD, 1  # every shared core is a crowd
    try:
        assert got() == want
    finally:
        suffix_dedup.CROWD = crowd


def test_no_run_falls_on_bit_zero(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 1)
    assert suffix_dedup._bit(b"key", 3, b"digest") == 1


@pytest.mark.parametrize("limit", [2, 7, 100_000])
def test_induced_sorting(limit):
    rng = random.Random(limit)
    for _ in range(300):
        t = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 50))] + [0]
        got = list(induced_sort.suffixes(t, 5, limit))
        assert [i for i, _ in got] == sorted(range(len(t)), key=lambda i: t[i:])
        for (i, common), (j, _) in zip(got, got[1:], strict=False):
            k = 0
            while k < 5 and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                k += 1
            assert common == k


def test_language(spark, docs, rows):
    for r in language_id.identify(docs).collect():
        assert 0 <= r["score"] <= 1
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    assert [got[i] for i in (900_001, 900_002, 900_003, 900_014)] == ["und"] * 4
    table = queries.QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = table.where("held_out").join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97


def test_preference(spark):
    table = queries.QUERIES["op9_preference"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    right = table.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right >= 0.93
    assert table.where("score < 0 or score > 1 or predicted != cast(score >= 0.3 as int)").isEmpty()


def test_preference_threshold_covers_all_labels(spark, monkeypatch):
    monkeypatch.setattr(preference, "SAMPLE", 25)
    monkeypatch.setattr(preference, "BINS", 16)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    made = [(k, " ".join(word() if rng.random() > k % 3 / 8 else rng.choice(["#", "!!", "12"]) for _ in range(rng.randrange(12, 60))),
             int(k % 3 != 2)) for k in range(900)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in made] + [(0, made[0][1])] * 20, "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in made], "doc_id long, quality int")
    got = preference.score(docs, labels, lambda c: F.lit(False)).collect()
    assert len(got) == 920 and sum(r["predicted"] == 0 for r in got) == 300
    scores = spark.createDataFrame([(float(x),) for x in [3] * 50 + list(range(200)) + [1e9]], "z double")
    assert [preference.ranked(scores, k) for k in (0, 3, 52, 53, 54, 250)] == [0, 3, 3, 3, 4, 1e9]


def test_preference_edge_cases(spark, docs, rows):
    labels = spark.createDataFrame([(900_012, 0, 0), (900_013, 0, 0), (900_007, 1, 0), (900_008, 1, 1), (900_008, 1, 0),
                                    (3, 1, 0), (None, 1, 0), (900_009, None, 0), (42, 7, 0)], "doc_id long, quality int, toxic int")
    got = preference.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(left.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    # Nothing that a stage removes is left.
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(brute.quality(t)[-1] for t in kept.values())
    assert not any(brute.base_secret_spans(t) for t in kept.values())
    assert not any(brute.benchmark_hits(t, items)[-1] for t in kept.values())
    groups = brute.components(list(kept.items()))
    assert all(c == i for i, (_, c) in groups.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF).collect()
    assert {r["doc_id"] for r in packed} == set(kept)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in packed)


@pytest.mark.parametrize("table", ["no_docs", "null_docs"])
def test_pipeline_stages_on_empty_and_null_tables(spark, request, table):
    import corpus_pipeline
    docs = request.getfixturevalue(table)
    n = docs.count()
    # A document without text is rejected by the first stage and left by the others.
    for (name, stage), left in zip(corpus_pipeline.STAGES[:-1], (0, n, n, n), strict=True):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == left, name
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()) == n
