"""Small tests of the training-data operators: brute force, round trips, held-out accuracy, edge rows."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import archives, html_text, ngram_join, packing, quality, secrets_scan, text_runs, toxicity, vector_links
from ledgerline.llm.links import components
from ledgerline.llm.mixing import mix
from ledgerline.llm.queries import ORACLES, QUERIES, VOCABULARY
from tests.conftest import SMALL
from tools.check_oracles import TABLES, keyed

EDGE = [
    (1, None, None, None), (2, "", "en", "src1"), (3, "a b", "en", None), (4, "a b", None, "src2"), (4, "a b", None, "src2"),
    (5, "word " * 30_000, "xx", "other"), (6, " \t\n ", "de", "src3"), (None, "no id here", "en", "src1"), (7, "ünïcode ﬁ 𝔘 €", "fr", "src1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA).withColumn("n_chars", F.length("text").cast("long")).withColumn("token", F.lit(1)).withColumn("root", F.lit("x")).withColumn("n", F.lit(2))


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b), near[b].add(a)

    def least(x):
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y), todo.append(y)
        return min(seen)

    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: least(x) for x in near if near[x] != {x}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_classes(rows, size, threshold):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for doc, text in rows:
        w = words((text or "").translate(low))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("open_pairs", [2, 0])
def test_jaccard_classes(spark, monkeypatch, open_pairs):
    monkeypatch.setattr(ngram_join, "OPEN_PAIRS", open_pairs)
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(60)) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "One two"), (3, "one TWO"), (4, "one two three four")]
    for k in range(5, 120):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = rng.choice("xyz")
        rows.append((k, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows, 4, 85)


def test_remove_repeats(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcd e") for _ in range(300)) for _ in range(3)]
    rows = [(0, None), (1, ""), (2, "a" * 150), (3, "é" * 60)]
    for k in range(4, 60):
        part = list(rng.choice(base)[rng.randrange(50) : rng.randrange(120, 300)])
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = rng.choice("xyz\0")
        rows.append((k, "".join(part) + rng.choice(["", "\0\0", "q" * 9])))
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[s : s + 40] for s in range(len(b) - 39))
    got = {r.doc_id: r for r in text_runs.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 40, 8).collect()}
    for k, t in rows:
        b = (t or "").encode()
        covered = np.zeros(len(b), bool)
        for s in range(len(b) - 39):
            if seen[b[s : s + 40]] > 1:
                covered[s : s + 40] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~covered])
        runs = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        assert (got[k].n_bytes, got[k].n_removed, len(got[k].spans), got[k].kept_sha256) == (len(b), int(covered.sum()), runs, hashlib.sha256(rest).hexdigest())


def test_multikey_quicksort():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order = text_runs.multikey_quicksort(rows, small=8)
    assert [tuple(x) for x in rows[order]] == sorted(tuple(x) for x in rows)


def test_packing(spark):
    from tokenizers import Tokenizer

    docs = small(spark, "documents")
    got = packing.pack(docs.select("doc_id", "text"), VOCABULARY).toPandas()
    tokenizer, want = Tokenizer.from_file(VOCABULARY), {}
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            want[r.doc_id, k // 2048] = (k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    own = got.sort_values(["sequence_id", "offset"])
    assert (own.groupby("sequence_id").length.cumsum() - own.length == own.offset).all()
    assert own.groupby("sequence_id").length.sum().max() <= 2048
    assert own.sequence_id.nunique() <= -(-own.length.sum() // 2048) + 1


def test_word_ids():
    from tokenizers import Tokenizer

    tokenizer, known = Tokenizer.from_file(VOCABULARY), {}
    odd = ["It's", "ΑΣ.", "İx!", "naïve,", "ét", "a~b", "~", "<|endoftext|>", "x²", "Å;", "...", "日本", " y", "A.b"]
    packing.word_ids(tokenizer, odd, known)
    for w in odd:
        assert known[w] == np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes(), w


def test_quality_counts_and_verdicts(spark):
    got = {r.doc_id: r for r in quality.judge(small(spark, "documents")).collect()}
    for r in small(spark, "documents").collect():
        w = words(r.text)
        threes = Counter(zip(w, w[1:], w[2:]))
        covered = {k for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)), len(covered)
        )
        assert g.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    labelled = [(got[r.doc_id], r.quality) for r in small(spark, "labels").collect()]
    assert all(g.kept for g, q in labelled if q == 1 and not g.base_failed)
    assert sum(g.kept for g, q in labelled if q == 0) < 0.6 * sum(q == 0 for _, q in labelled)


def test_each_quality_rule_by_itself(spark):
    docs = small(spark, "documents").select("doc_id", "lang", "text")
    good = {r.doc_id for r in small(spark, "labels").where("quality = 1").collect()}
    judged = {r.doc_id: r for r in quality.judge(docs).collect()}
    source = [r for r in docs.collect() if r.doc_id in good and judged[r.doc_id].kept and judged[r.doc_id].n_words >= 150][:4]
    assert len(source) == 4
    common = set(quality._vocabulary())
    rename = lambda t: re.sub(r"\S+", lambda m: "zq" + m.group() if m.group().lower() in common else m.group(), t)
    noise = lambda t: re.sub(r"\S+", lambda m: m.group() if m.group().lower() in common else m.group() + "#%&*" * 3, t)
    # The same documents without common words, and with symbols at all other words.
    rows = [(10_000 + k, r.lang, rename(r.text)) for k, r in enumerate(source)] + [(20_000 + k, r.lang, noise(r.text)) for k, r in enumerate(source)]
    got = {r.doc_id: r for r in quality.judge(docs.unionByName(spark.createDataFrame(rows, "doc_id long, lang string, text string"))).collect()}
    for k, r in enumerate(source):
        foreign, noisy = got[10_000 + k], got[20_000 + k]
        assert got[r.doc_id].kept
        assert not foreign.base_failed and not foreign.kept and foreign.class_distance <= quality.CLASS_LIMIT
        assert not noisy.base_failed and not noisy.kept and noisy.word_distance <= got[r.doc_id].word_distance + 1e-9


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert keyed(df.columns, df.collect()) == keyed(names, cursor.fetchall())


def test_archive_faults():
    import struct

    import zstandard

    record = archives.build_record(5, "http://x", b"<p>hi</p>", None, False)
    lead = archives.DICTIONARY_FRAME + struct.pack("<I", 0)
    pack = zstandard.ZstdCompressor().compress
    whole = lead + pack(record) + archives.LINE_END_FRAME + b"\n" + pack(archives.build_record(6, None, b"<p>hi</p>", 5, True))
    found = list(archives.read_archive(whole))
    assert [(r[0], r[1], r[3], r[4], r[6]) for r in found] == [(5, "response", 9, None, b"<p>hi</p>"), (6, "revisit", 9, 5, None)]
    for bad in (whole[:-3], whole[4:], lead + pack(record[:-1]), lead + pack(record.replace(b"hi", b"ho")), lead + pack(record.replace(b"WARC-Date", b"Date")), lead + b"rubbish!!"):
        with pytest.raises(archives.ArchiveError):
            list(archives.read_archive(bad))


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 32))
    rows = [(k, (base[k % 60] + 0.15 * rng.standard_normal(32)).tolist()) for k in range(300)]
    rows += [(300, rows[0][1]), (301, None), (302, [0.0] * 32), (303, [float("nan")] + [1.0] * 31), (304, []), (305, [None, 1.0]), (306, [1.0, 2.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_links.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = np.array([v for _, v in rows[:301]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert sum(got[k][0] for k in range(301)) >= 0.9 * links.sum() and all(got[k][0] <= links[k] for k in range(301))
    assert all(got[k] == (0, k, True) for k in range(301, 307)) and got[300][1] == got[0][1]


def test_main_text_of_pages(spark):
    tree = html_text.train_tree(*html_text.labelled_table())
    for r in small(spark, "pages").collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split(r"</?p>|<br>|</?h1>", article))
        assert html_text.main_text(r.html, tree) == "\n".join(p for p in parts if p)
    page = '<div id=menu><a href=x>Home</a></div><main><p>Real text of the page, long enough to be &amp; stay.</p></main><div class="comments"><p>First! ' + "me too " * 30 + "</p></div>"
    assert html_text.main_text(page, tree) == "Real text of the page, long enough to be & stay."
    assert html_text.main_text("", tree) == "" and html_text.main_text("<script>x", tree) == ""


def test_secrets(spark):
    text = 'x Token = "abc/def=12" password: token: abcdefghijk AKIAABCDEFGHIJKL ' + "0a" * 16 + "Z"
    spans = secrets_scan.base_spans(text)
    assert secrets_scan.joined(spans) == "assign:2:21,access:52:68,hex:69:101"
    net = secrets_scan.trained()
    windows, labels = secrets_scan.labelled_findings(400, 77)
    p = net.probability(secrets_scan.as_codes(windows))
    assert (p[labels == 1] >= net.limit).mean() > 0.85 and (p[labels == 0] >= net.limit).mean() < 0.15
    assert "abc/def" not in secrets_scan.redacted(text, net)


def test_secrets_in_every_wide_run():
    net = secrets_scan.trained()
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    key = lambda n, alphabet: "".join(rng.choice(alphabet) for _ in range(n))
    both = letters + letters.upper()
    path = "/".join(["docs", "images", "guide", "chapter", "drawings", "figures", "archive"] * 2) + "/"
    few_digits = [key(26, both) + "7" for _ in range(100)]
    plain = [key(30, both + "0123456789") for _ in range(100)]
    for texts in ([f"see {k} here" for k in few_digits], [f"see {path}{k} here" for k in plain], [f"see {'=' * 60}{k} here" for k in plain], [f"see {path}{k}/{path} here" for k in plain]):
        assert sum("[secret]" in secrets_scan.redacted(t, net) for t in texts) >= 90
    harmless = [f"see {path}{path} here", "see " + "=" * 100 + " here", "eine donaudampfschifffahrtsgesellschaft hier", "the CustomerOrderHistoryServiceFactory class"]
    assert sum("[secret]" in secrets_scan.redacted(t, net) for t in harmless) == 0
    # The last window of a long run shows what stands after it.
    views = [v for _, v in secrets_scan.windows_of("a" * 100 + " after it all", 0, 100)]
    assert " after it all"[: secrets_scan.AFTER] in views[-1]


def test_toxicity_held_out(spark):
    # sf0.01 has six held-out toxic rows and some 35 to learn from: too few to measure a ranking.
    df = toxicity.score_toxicity(spark.read.parquet(SMALL.replace("0.001", "0.1") + "/documents.parquet"), spark.read.parquet(SMALL.replace("0.001", "0.1") + "/labels.parquet"))
    m = df.toPandas().merge(spark.read.parquet(SMALL.replace("0.001", "0.1") + "/labels.parquet").toPandas(), on="doc_id")
    held = m[m.held_out]
    one, two = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert (one[:, None] > two).mean() > 0.9
    assert m.score.between(0, 1).all() and all(zlib.crc32(str(d).encode()) % 5 == 0 for d in held.doc_id)


def test_edge_rows_and_clashing_columns(spark, edge):
    n = len(EDGE)
    labels = spark.createDataFrame([(3, 1), (5, None)], "doc_id long, toxic int")
    for df in (toxicity.score_toxicity(edge, labels), quality.judge(edge), secrets_scan.scan(edge), text_runs.remove_repeats(edge), ngram_join.jaccard_classes(edge)):
        assert len(df.collect()) == n
    assert packing.pack(edge, VOCABULARY).select("doc_id", "piece").where("piece = 0").count() == n
    assert mix(edge, 100, 1).count() <= n
    none = edge.limit(0)
    for df in (toxicity.score_toxicity(none, labels), quality.judge(none), secrets_scan.scan(none), text_runs.remove_repeats(none), ngram_join.jaccard_classes(none), packing.pack(none, VOCABULARY), mix(none)):
        assert df.count() == 0


def test_pipeline_stages(spark, edge):
    docs = small(spark, "documents")
    first = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in first.collect()} == kept
    rows = [(r.doc_id, r.text) for r in first.collect()]
    second = corpus_pipeline.STAGES[1][1](spark, first, SMALL)
    assert {r.doc_id for r in second.collect()} == {d for d, (_, c) in brute_classes(rows, 5, 80).items() if d == c}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, SMALL)
        assert out.columns == edge.columns or name == "packing"
        out.collect()
