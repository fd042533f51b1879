"""Fill-in-the-middle, token alignment and URL rules against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrovia.llm import common, fill_in_middle, queries, token_alignment, url_rules
from tests.llm import brute
from tests.llm.conftest import SF

BYTE_BPE = queries.tokenizer("byte_bpe_50k.json")
PIECE_BPE = queries.tokenizer("piece_bpe_32k.model")


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


# --- fill in the middle ---------------------------------------------------------------

UNIT_PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]|[^\x20\x09-\x0D]+",
                 "sentence": r"[^\n.!?…。！？]*[\n.!?…。！？]|[^\n.!?…。！？]+"}


def plain_cut(doc_id, text, unit="line", seed=7):
    """(n, form, prefix chars, middle chars, output) of one text."""
    t = text or ""
    units = re.findall(UNIT_PATTERNS[unit], t)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t:
        return len(units), "plain", None, None, t
    if h4 % 100 < 50:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


CUT_CASES = [(1, "a <P> of its own\nand more"), (2, "\n\n\n"), (3, "no line end"), (4, "x\n"), (5, "<S>"), (6, "<|M>\n<p>\n<S\n"),
             (7, "\U0001f600 wide\nché. Ünï!\n"), (8, "end. of! a? sentence…\nthen"), (9, " lead\ttab\r\nand \x0b\x0c")]


@pytest.mark.parametrize("unit", UNIT_PATTERNS)
def test_cuts(spark, docs, rows, unit):
    extra = spark.createDataFrame(CUT_CASES, "doc_id long, text string")
    out = fill_in_middle.fill_in_middle(docs.select("doc_id", "text").union(extra), unit)
    want = Counter((i, *plain_cut(i, t, unit)) for i, t in [*((i, t) for i, t, _ in rows), *CUT_CASES])
    assert tuples(out) == want
    back = out.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")))
    assert tuples(back) == Counter((i, t or "") for i, t in [*((i, t) for i, t, _ in rows), *CUT_CASES])


def test_cut_rates(spark):
    docs = spark.createDataFrame([(i, "one\ntwo\nthree") for i in range(200)], "doc_id long, text string")
    assert {r["form"] for r in fill_in_middle.fill_in_middle(docs, fim_percent=0).collect()} == {"plain"}
    forms = Counter(r["form"] for r in fill_in_middle.fill_in_middle(docs, fim_percent=50, spm_percent=100).collect())
    assert set(forms) == {"plain", "spm"} and 60 < forms["spm"] < 140


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        for bits in (1, 2, 3):
            codes = rng.integers(0, 1 << bits, size).astype(np.uint8)
            matrix = fill_in_middle.WaveletMatrix(codes, bits)
            for c in range(1 << bits):
                places = np.flatnonzero(codes == c)
                ranks = np.concatenate([[0], np.cumsum(codes == c)])
                assert np.array_equal(matrix.rank(c, np.arange(size + 1)), ranks)
                assert np.array_equal(matrix.select(c, np.arange(len(places))), places)


def test_slices(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "SLICE_CHARS", 10)
    texts = ["abc", "", "x" * 40, "de", "fghijklm", ""]
    assert list(fill_in_middle.slices(texts)) == [(0, 2), (2, 3), (3, 6)]
    assert list(fill_in_middle.slices([])) == [] and list(fill_in_middle.slices([""])) == [(0, 1)]


# --- token alignment ------------------------------------------------------------------

def plain_alignment(texts):
    """Contract columns of each text, from whole texts and byte offsets."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_tok = Tokenizer.from_file(BYTE_BPE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    name = {i: t for t, i in a_tok.get_vocab().items()}
    byte = token_alignment.byte_of_symbol()

    def a_bytes(i):
        return bytes(byte[c] for c in name[i])

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        m = re.fullmatch("<0x(..)>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("\u2581", " ").encode()

    made, holds = [], Counter()
    for t in texts:
        a = a_tok.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_tok.encode(t or "")
        ab, bb, raw = [a_bytes(i) for i in a], [b_bytes(i) for i in b], (" " + (t or "")).encode()
        if not t or b"".join(ab) != raw or b"".join(bb) != raw:
            made.append(None)
            continue
        ranges = []
        for ids, parts in ((a, ab), (b, bb)):
            at, out = 0, []
            for i, p in zip(ids, parts, strict=True):
                out.append((i, at, at + len(p)))
                at += len(p)
            ranges.append(out)
        links, j0 = [], 0
        for i, s, e in ranges[0]:
            while ranges[1][j0][2] <= s:
                j0 += 1
            links += [(i, k) for k, s2, e2 in ranges[1][j0:j0 + len(raw)] if s2 < e and s < e2] if len(raw) < 400 else [
                (i, k) for k, s2, e2 in ranges[1][j0:j0 + 60] if s2 < e and s < e2]
        cuts = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, x, y = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while x < len(a) and ranges[0][x][2] <= c:
                ga.append(str(a[x]))
                x += 1
            while y < len(b) and ranges[1][y][2] <= c:
                gb.append(str(b[y]))
                y += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        made.append((len(a), len(b), groups, links))
        holds.update(set(links))
    best = defaultdict(int)
    for (i, _), n in holds.items():
        best[i] = max(best[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if m is None else
            (m[0], m[1], len(m[2]), len(m[3]), sum(holds[p] == best[p[0]] for p in m[3]), sum(holds[p] for p in m[3]),
             brute.sha(";".join(m[2]))) for m in made]


ODD_TEXTS = ["the \u2581 sign", "a\n b\n\n  c ", "   ", " ", "\n", "x  \u3000 y", "</s> <s> <unk> <0x41>", "日本 語テキスト。  ok",
             "don't 's  I'LL\t\tx", "a\x00b \x1c c", "e\u0301 \ufb01 \u1e9b\u0323", "trailing  ", "\u0085 \u00a0 z"]


@pytest.mark.parametrize("hot_share", [token_alignment.HOT_SHARE, 40])
def test_alignment(spark, docs, rows, hot_share):
    texts = [(i, t) for i, t, _ in rows] + [(800_000 + k, t) for k, t in enumerate(ODD_TEXTS)]
    extra = spark.createDataFrame(texts[len(rows):], "doc_id long, text string")
    out = token_alignment.align(docs.select("doc_id", "text").union(extra), BYTE_BPE, PIECE_BPE, hot_share)
    want = Counter((i, *p) for (i, _), p in zip(texts, plain_alignment([t for _, t in texts]), strict=True))
    assert tuples(out) == want


def test_terminals_are_common_ends():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(1, 40))), n)) for _ in range(2))
        to = token_alignment.terminals(a, b)
        both = np.intersect1d(a, b)
        want = np.searchsorted(both, np.concatenate([a, b]))
        assert np.array_equal(b[to - len(a)], both[want])
        pairs = set(zip(*token_alignment.overlaps(a, b), strict=True))
        starts = [np.concatenate([[0], e[:-1]]) for e in (a, b)]
        assert pairs == {(i, j) for i in range(len(a)) for j in range(len(b))
                         if starts[0][i] < b[j] and starts[1][j] < a[i]}


def test_pieces_held_are_bounded(monkeypatch):
    monkeypatch.setattr(token_alignment, "HELD_PIECES", 3)
    aligner = token_alignment.Aligner(BYTE_BPE, PIECE_BPE)
    for t in ("one two three four five", "six \u2581 seven one", "", "one two three four five"):
        first, again = aligner.texts([t, "one"]), token_alignment.Aligner(BYTE_BPE, PIECE_BPE).texts([t, "one"])
        assert all(np.array_equal(x, y) for x, y in zip(first, again, strict=True))


# --- url rules ------------------------------------------------------------------------

FIXED = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def plain_parts(url):
    if not url or "://" not in url:
        return "", "", ""
    after = url.split("://", 1)[1]
    end = min([i for i in (after.find(c) for c in "/?#") if i >= 0] or [len(after)])
    host, rest = brute.lower(after[:end]), after[end:]
    stop = min([i for i in (rest.find(c) for c in "?#") if i >= 0] or [len(rest)])
    return host, rest[:stop], rest[stop:]


def plain_rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in FIXED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def plain_tokens(parts):
    host, path, rest = parts
    out = []
    for text, cut, kind in ((host, r"\.", "h:"), (path, r"[\W_]+", "p:"), (rest, r"[\W_]+", "q:")):
        words = [w for w in re.split(cut, brute.lower(text)) if w]
        out += [kind + (brute.sha(w) if len(w) > 64 else w) for w in words]
        out += [f"{kind}#{min(len(w), 20)}" for w in words if re.fullmatch("[0-9]+", w)]
    return set(out)


def plain_verdicts(urls):
    """Every set of up to four tokens is tried; every rule is tried on every url."""
    parts = [plain_parts(u) for u in urls]
    ruled = [plain_rule(h, p) for h, p, _ in parts]
    labelled = {u: (plain_tokens(x), v == "block") for u, x, (r, v) in zip(urls, parts, ruled, strict=True) if r}
    n, k = len(labelled), sum(b for _, b in labelled.values())
    rules = {}
    if 0 < k < n:
        least = max(5, -(-n * 2 // 1000))
        share = k / n
        count, blocked = Counter(), Counter()
        for tokens, b in labelled.values():
            count.update(tokens)
            blocked.update(tokens if b else ())
        told = {t: round(abs(blocked[t] - c * share) / (c * share * (1 - share)) ** .5, 6)
                for t, c in count.items() if c >= least}
        all_sets, by_verdict = Counter(), Counter()
        for tokens, b in labelled.values():
            kept = sorted((t for t in tokens if t in told), key=lambda t: (-told[t], t))[:12]
            for size in range(1, 5):
                for s in combinations(sorted(kept), size):
                    all_sets[s] += 1
                    by_verdict[s, b] += 1
        sure = {(s, b): (c / all_sets[s], c) for (s, b), c in by_verdict.items() if c >= least and c / all_sets[s] >= .8}
        rules = {(s, b): x for (s, b), x in sure.items()
                 if not any((part, b) in sure and sure[part, b][0] >= x[0]
                            for size in range(1, len(s)) for part in combinations(s, size))}
    ordered = sorted(rules, key=lambda r: (-rules[r][0], -rules[r][1], len(r[0]), r[0], r[1]))
    out = []
    for x, (rule, verdict) in zip(parts, ruled, strict=True):
        have = plain_tokens(x)
        first = next((b for s, b in ordered if set(s) <= have), False)
        out.append((x[0], x[1], rule, verdict or ("block" if first else "allow")))
    return out


URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG", "http://org/", "http://ORG/es/1", "x://example.org/es/", "http://example.org/en/1",
        "http://a.example.org/en/12#x", "http://notexample.org/en/1", "http://b.com/fr/1", "http://b.com/fr", "http://b.com/de/?q=1",
        "http://com/de/x", "http://x.net/es/77", "http://x.net/de/77/?a=b#c", "mailto:x@y", "http://u@h.com:80/de/../x", "a://b://c/d",
        "http://É.example.org/es/Ünï", "http://x.org/" + "long" * 30, "http://y.net\n/de/x\ny?z", "http://x.net?a=://b/de/"]


@pytest.fixture(scope="module")
def urls():
    import pyarrow.parquet as pq
    made = [f"http://{s}.example.{t}/{lang}/{i}" for i, (s, t, lang) in enumerate(
        (s, t, lang) for s in ("a", "b", "www.c") for t in ("org", "com", "net") for lang in ("en", "es", "de", "fr") for _ in range(4))]
    return URLS + made + made[:7] + [r["url"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]


def test_url_rules(spark, urls):
    pages = spark.createDataFrame([(i, u, None, "x", "y", True) for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, tokens string, rule string, blocked boolean")
    out = url_rules.judge(pages.repartition(5)).orderBy("page_id").collect()
    assert [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out] == [
        (i, *v) for i, v in enumerate(plain_verdicts(urls))]
    assert {r["verdict"] for r in out if r["rule"] is None} == {"allow", "block"}
    assert all((r["mined"] is None) == (r["confidence"] is None) and not (r["rule"] and r["mined"]) for r in out)


def test_rules_of_all_tokens(spark):
    """Rules of urls with up to 22 frequent tokens, against every set of up to four."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        blocked = bool(rng.integers(2))
        tokens = [f"p:{t:02d}" for t in range(22) if rng.random() < (.35 + .4 * (t + blocked) % .5)]
        tokens += ["p:both", "p:same"] if i % 3 == 0 else []        # equal urls: no surer than one alone
        tokens += ["q:only"] if blocked and i % 2 else []           # one verdict only
        rows.append((f"u{i}", [tokens[k] for k in rng.permutation(len(tokens))], blocked))
    out = url_rules.association_rules(spark.createDataFrame(rows, "url string, tokens array<string>, blocked boolean"), least=12)
    got = {(tuple(r["tokens"]), r["blocked"]): (r["support"], r["confidence"], r["rarest"]) for r in out.collect()}
    count, by_verdict = Counter(), Counter()
    for _, tokens, blocked in rows:
        for size in range(1, 5):
            for s in combinations(sorted(tokens), size):
                count[s] += 1
                by_verdict[s, blocked] += 1
    sure = {x: c / count[x[0]] for x, c in by_verdict.items() if c >= 12 and c / count[x[0]] >= .8}
    want = {(s, b): (by_verdict[s, b], c, min(s, key=lambda t: (count[t,], t))) for (s, b), c in sure.items()
            if not any(sure.get((part, b), 0) >= c for size in range(1, len(s)) for part in combinations(s, size))}
    assert got == want and {len(s) for s, _ in want} >= {1, 2, 3, 4}
    common.drop_stored(out)


def test_many_rules_are_joined(spark, urls, monkeypatch):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    by_index = url_rules.judge(pages)
    index_rows = [(*r[:5], r["mined"] and tuple(r["mined"]), r["confidence"]) for r in by_index.collect()]
    monkeypatch.setattr(url_rules, "INDEXED", 0)
    by_join = url_rules.judge(pages)
    assert by_join.dtypes == by_index.dtypes
    assert Counter((*r[:5], r["mined"] and tuple(r["mined"]), r["confidence"]) for r in by_join.collect()) == Counter(index_rows)
    assert any(r[5] for r in index_rows)
    common.drop_stored(by_join)


def test_url_tables_without_labels(spark):
    schema = "page_id long, url string, html string"
    assert url_rules.judge(spark.createDataFrame([], schema)).collect() == []
    nothing = spark.createDataFrame([(None, None, None), (None, None, None), (1, "http://a.net/de/", None)], schema)
    assert tuples(url_rules.judge(nothing).select("page_id", "host", "path", "rule", "verdict")) == Counter(
        {(None, "", "", None, "allow"): 2, (1, "a.net", "/de/", None, "allow"): 1})
    one_kind = spark.createDataFrame([(i, f"http://a{i}.com/de/", None) for i in range(9)], schema)
    assert {r["verdict"] for r in url_rules.judge(one_kind).collect()} == {"block"}


@pytest.mark.parametrize("run", [
    lambda d: fill_in_middle.fill_in_middle(d), lambda d: token_alignment.align(d, BYTE_BPE, PIECE_BPE)])
def test_empty_and_null_tables(no_docs, null_docs, run):
    assert run(no_docs).collect() == []
    got = run(null_docs).collect()
    assert len(got) == 2 and {r["doc_id"] for r in got} == {None}


def test_no_scratch_is_left(spark, docs, tmp_path):
    from ferrovia.session import checkpoint_root, child_folders
    before = set(child_folders(spark, checkpoint_root(spark)))
    token_alignment.align(docs, BYTE_BPE, PIECE_BPE).collect()
    url_rules.judge(common.load(spark, SF, "pages")).collect()
    left = {n.rsplit("-", 1)[0] for n in set(child_folders(spark, checkpoint_root(spark))) - before}
    assert left <= {"aligned"}     # the result itself
