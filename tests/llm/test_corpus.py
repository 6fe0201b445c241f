"""The corpus operators against brute force, SQL and the library, on untidy documents."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import rows_of_spark, rows_of_sql
from rxtrail.llm import bpe, exact, html, mixing, pii, quality, shared, simhash, substring, tokenfile, toxicity
from rxtrail.llm.queries import TOKENIZER

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "place string, mix int, verdict string, size int, digest string, lane int, fp long, root long, n long"
)
LIBRARY = Tokenizer.from_file(TOKENIZER)


def texts() -> list[str | None]:
    pick = random.Random(7)
    word = lambda: "".join(pick.choice(["an", "the", "é", "ing", "or", "st"]) for _ in range(pick.randrange(1, 4)))
    some = [" ".join(word() for _ in range(pick.randrange(1, 90))) + "." for _ in range(60)]
    some += [some[0].upper(), some[1], some[1], some[2] + " more", some[3].replace(" ", "\n", 9)]
    some += [some[4] + " " + some[5], some[6] + "\n" + some[6], "x " * 500, "y" * 5000, "Home\nLogin\n" + some[8]]
    some += ["a@b.co, 1.2.3.4, 4111 1111 1111 1111, +1 (803) 555-5351", "<|endoftext|> İΣ é", "", None, " \t\n", "\x85\xa0"]
    return some + ["# $ % & | " * 20, " | ".join(some[9].split()), "really!! bad!! text!! " * 12, some[10] + " cookie policy\n" + some[11]]


def rows() -> list[tuple]:
    made = [(i * 3, t, "en", [f"s{i % 5}", None][i % 11 == 0], len(t or ""), "p", 1, "v", 2, "d", 0, 5, 6, 7) for i, t in enumerate(texts())]
    return [*made, made[0], (None, "no id here " * 9, None, None, *[None] * 10), (None, *made[1][1:])]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def unique(docs):
    """Without repeated or missing ids, which SQL and brute force tell apart by id."""
    return docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])


def in_duckdb(docs):
    documents = docs.select("doc_id", "text", "source").toArrow()  # noqa: F841
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents AS SELECT * FROM documents")
    return connection


def by_id(frame) -> dict:
    return {row.doc_id: row for row in frame.collect()}


def text_of(docs) -> dict[int, str]:
    return {row.doc_id: row.text or "" for row in docs.select("doc_id", "text").collect()}


def test_sql_reports(spark, docs, unique):
    store = shared.staging(spark)
    for frame, sql in [
        (quality.report(docs), quality.SQL_REPORT),
        (mixing.report(docs, store), mixing.SQL_REPORT),
    ]:
        ours, theirs = rows_of_spark(frame), rows_of_sql(in_duckdb(docs), sql)
        assert ours[0] == theirs[0] and not ours[1] - theirs[1] and not theirs[1] - ours[1]
    assert rows_of_spark(exact.report(unique, store)) == rows_of_sql(in_duckdb(unique), exact.SQL_REPORT)


def test_exact_on_repeated_rows_and_equal_digests(spark, docs):
    kept = exact.kept(docs, shared.staging(spark))
    assert kept.columns == docs.columns
    left = Counter((r.text or "").translate(shared.ASCII_LOWER) for r in kept.collect())
    assert set(left.values()) == {1}
    assert left.keys() == {(t or "").translate(shared.ASCII_LOWER) for _, t, *_ in rows()}
    weak = exact.groups(docs, shared.staging(spark), digest=lambda text: exact.F.length(text).cast("string"))
    strong = exact.groups(docs, shared.staging(spark))
    columns = ["place", "doc_id", "keep_id", "group_size", "kept"]
    assert rows_of_spark(weak.select(columns)) == rows_of_spark(strong.select(columns))


def test_substrings(docs, unique):
    known = {i: shared.python_words(t) for i, t in text_of(unique).items()}
    least: dict = {}
    for i, w in known.items():
        for k in range(len(w) - 12):
            least[tuple(w[k : k + 13])] = min(least.get(tuple(w[k : k + 13]), i), i)
    for frame in (substring.cleaned(unique), substring.cleaned(unique, run_words=300)):
        found = by_id(frame)
        assert found.keys() == known.keys()
        for i, w in known.items():
            gone = {k + j for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < i for j in range(13)}
            assert found[i].kept == " ".join(x for k, x in enumerate(w) if k not in gone)
            assert found[i].n_words == len(w) and sum(r.end - r.start for r in found[i].removed) == len(gone)
    assert substring.report(docs).count() == len(rows())


def test_token_store(spark, docs):
    found = tokenfile.report(docs, shared.staging(spark), TOKENIZER).collect()
    assert len(found) == len(rows())
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])]
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    wanted = Counter()
    for i, text, *_ in rows():
        tokens = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[i, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted


def test_elias_fano():
    pick = np.random.default_rng(3)
    for n in (0, 1, 2, 64, 65, 500):
        for gap in (2, 9, 70_000):
            values = np.cumsum(pick.integers(1, gap, n))
            index = tokenfile.EliasFano.of(values)
            assert index.all().tolist() == values.tolist() == [index[i] for i in range(n)]


def test_simhash(spark, docs, unique):
    words = text_of(unique)
    prints = {i: simhash.fingerprint(t.encode()) for i, t in words.items()}
    group = {i: {j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2} for i in prints}
    least = {i: i for i in prints}
    for _ in prints:
        least = {i: min(least[j] for j in group[i]) for i in prints}
    found = by_id(simhash.report(unique, shared.staging(spark)))
    assert {i: (f"{prints[i]:016x}", least[i]) for i in prints} == {i: (r.fingerprint, r.component_id) for i, r in found.items()}
    kept = simhash.kept(docs, shared.staging(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))


def test_simhash_links_in_crowded_anchors(spark):
    pick = random.Random(2)
    prints = {pick.getrandbits(64) for _ in range(300)}
    for x in list(prints)[:9]:
        prints |= {x ^ 1 << a ^ 1 << b ^ 1 << c for a in range(0, 60, 9) for b in range(5) for c in range(60, 64)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(x - (x >> 63 << 64),) for x in prints], "fp long")
    group = {x: {y for y in prints if (x ^ y).bit_count() <= 2} for x in prints}
    for most in (4096, 3):
        store = shared.staging(spark)
        links = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(frame, store, most).collect()]
        assert all(y in group[x] for x, y in links)
        label = {x: x for x in prints}
        for _ in range(60):
            for x, y in links:
                label[x] = label[y] = min(label[x], label[y])
        wanted = {x: x for x in prints}
        for _ in range(60):
            wanted = {x: min(wanted[y] for y in group[x]) for x in prints}
        assert label == wanted


def test_simhash_links_pairs_that_differ_in_the_sign_bit(spark):
    pick = random.Random(11)
    base = lambda: pick.getrandbits(64)
    near = [(x, x ^ 1 << 63 ^ (1 << k if k < 63 else 0)) for k in range(64) for x in [base()]]
    far = [(x, x ^ flip) for flip in (0b111 << 61, (1 << 18) - 1 << 46) for x in [base()]]
    prints = [p - (p >> 63 << 64) for pair in near + far for p in pair]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {frozenset((r.u % 2**64, r.v % 2**64)) for r in simhash.links(frame, shared.staging(spark)).collect()}
    assert found == {frozenset(pair) for pair in near}


def test_bpe(docs):
    found = Counter(tuple(r) for r in bpe.report(docs, TOKENIZER).collect())
    wanted = Counter()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for i, text, *_ in rows():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        wanted[i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))] += 1
    assert found == wanted


def test_transducer_emits_final_tokens():
    model, pick = bpe.BpeModel(TOKENIZER), random.Random(4)
    for letters in ("ab", "thein", "lo", "é日"):
        data = "".join(pick.choice(letters) for _ in range(2500)).encode()
        way = bpe.Transducer(model, 2 * model.lookahead)
        ids, held = [], 0
        for i in range(0, len(data) - 1, 100):
            ids += way.feed(data[i : min(i + 100, len(data) - 1)])
            held = max(held, len(way.held))
        assert [*ids, *way.finish(data[-1])] == LIBRARY.encode(data.decode(), add_special_tokens=False).ids
        assert held <= 2 * model.lookahead + 100
    plain = bpe.Decoder(model, plain=True)
    ids = LIBRARY.encode("café at noon", add_special_tokens=False).ids
    assert "".join(plain.feed([i]) for i in ids) + plain.finish() == "café at noon "


def test_pii(docs):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    sizes = {"card": range(13, 20), "phone": range(9, 16)}

    def brute(text):
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                    continue
                if kind in sizes and len(digits) not in sizes[kind] or kind == "card" and not pii.luhn(digits):
                    continue
                yield kind, *m.span()

    pick = random.Random(1)
    for _ in range(4000):
        text = "".join(pick.choice(pick.choice(["a.@-b", "0123456789 -", "12.3.", "+1 (2)3-", "éß \n"])) for _ in range(50))
        assert pii.base_spans(text) == list(brute(text))
    found = pii.report(docs).collect()
    assert len(found) == len(rows())
    assert sum(r.n_email for r in found) == sum(r.n_card for r in found) == sum(r.n_phone for r in found) == 1
    for r in pii.found(docs, pii.Trees()).where("n_ip > 0").collect():
        assert r.redacted == "[EMAIL], [IP], [CARD], [PHONE]"


def test_added_spans_cover_something_new_and_do_not_overlap_each_other(monkeypatch):
    trees = pii.Trees(trees=[[]], thresholds=dict.fromkeys(pii.KINDS, 0.5))
    monkeypatch.setattr(pii.Trees, "scores", lambda self, x: np.full(len(x), 0.9))
    text = " ".join(f"call (803) 555-{i % 7000 + 1000} token=abcdef0123456789{i} +1 (803) 555-5351 4111 1111 1111 1111" for i in range(3000))
    base, every = pii.select(text, trees)
    assert set(base) <= set(every) and len(every) > len(base)
    spans = sorted((a, b) for _, a, b in set(every) - set(base))
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
    covered = {i for _, a, b in base for i in range(a, b)}
    assert all(not covered.issuperset(range(a, b)) for a, b in spans)


def test_long_secrets_are_proposed_and_redacted_whole(monkeypatch):
    trees = pii.Trees(trees=[[]], thresholds=dict.fromkeys(pii.KINDS, 0.5))
    monkeypatch.setattr(pii.Trees, "scores", lambda self, x: np.full(len(x), 0.9))
    pick = random.Random(3)
    token = "".join(pick.choice("GHJKLMNPQRSTUVWXYZ_-") for _ in range(603))
    keys = ["a" * 60 + "0123456789abcdef" * 9, "0" + "b" * 128, "c0ffee" * 200_000]
    for text, secret in [(f"token={token} end", token), *((f"see {k} end", k) for k in keys)]:
        start = text.index(secret)
        assert ("secret", start, start + len(secret)) in {c[:3] for c in pii.candidates(text, pii.base_spans(text))}
    for text in (f"token={token} end", f"see {keys[1]} end"):
        assert pii.redacted(text, pii.select(text, trees)[1]) in ("token=[SECRET] end", "see [SECRET] end")


def test_rare_kinds_get_a_threshold_beside_common_ones_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_ROWS", 400)
    pick = random.Random(4)
    secret = lambda: "".join(pick.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(24))
    some = [f"order {pick.randrange(10**8, 10**9)} of {i}.{i}.{i}.{pick.randrange(400)}, call +1 (803) 555-{i:04}" for i in range(2500)]
    some += [f'the token = "{secret()}" is kept' for _ in range(60)] + [f"the key is aaaaaaaa{i % 7}" for i in range(60)]
    some += [" ".join(f"ticket {i}555 0{i}2 00{i}" for i in range(10, 60))] * 1300
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string").repartition(4)
    trees = pii.fit(frame)
    assert trees.thresholds["secret"] < 1
    texts = frame.select("text")
    x, y = pii.draw(texts, shared.staging(spark), 40)
    assert max(Counter(zip(x[:, 0], y, strict=True)).values()) == 40
    assert sum((x[:, 0] == pii.KINDS.index("secret")) & (y == 1)) == 40
    counts = pii.held_out_counts(texts, trees)
    assert sum(n for (kind, _, label), n in counts.items() if pii.KINDS[kind] == "secret" and label) == 60


def test_memo_is_bounded():
    memo = shared.Memo(10, len)
    long = "x" * (shared.LONGEST_KEY + 1)
    assert memo[long] == len(long) and long not in memo
    assert [memo[str(i)] for i in range(25)] == [len(str(i)) for i in range(25)]
    assert len(memo) + len(memo.old) <= 20


def test_trees_learn_and_calibrate():
    pick = np.random.default_rng(5)
    x = pick.normal(size=(3000, 4))
    x[:, 0] = pick.integers(0, len(pii.KINDS), 3000)
    y = ((x[:, 1] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = pii.Trees().fit(x[:2000], y[:2000])
    assert ((trees.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    trees.calibrate(x[2000:], y[2000:])
    assert all(t >= 0.5 for t in trees.thresholds.values())


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = toxicity.report(docs, labels, shared.staging(spark)).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    rank = found["score"].rank().to_numpy()
    ones = found["toxic"].to_numpy() == 1
    auc = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc > 0.7  # few labels here; 0.97 on the tables ten times as large


def test_toxicity_tells_features_apart(monkeypatch):
    texts = [" ".join(f"w{i}" for i in range(5000))] * 2 + ["w1 " * 3, "w1 " * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([None, 1, 0, None], pa.int32())], ["text", "toxic"])
    one, totals = toxicity.features_of("w1")[0], []
    for held in (1 << 21, 7):
        monkeypatch.setattr(toxicity, "HELD", held, raising=False)
        counts = Counter()
        for part in toxicity._counts(iter([batch])):
            for feature, *n in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for name, x in zip(("toxic", "clean", "all"), n, strict=True):
                    counts[feature if feature is None else feature % 2**64, name] += x
        assert [counts[one, name] for name in ("toxic", "clean", "all")] == [1, 3, 9]
        totals.append([counts[None, name] for name in ("toxic", "clean", "all")])
        assert all(sum(n for (f, x), n in counts.items() if x == name and f is not None) == counts[None, name] for name in ("toxic", "all"))
    assert totals[0] == totals[1]
    assert len({f for i in range(60_000) for f in toxicity.features_of(f"v{i:07}")[:1]}) == 60_000


def test_occurrences_count_ever_less_without_bound():
    times = np.array([1, 2, 3, 4, 31, 32, 255, 256, 4 * 8**12])
    assert toxicity.evidence(times).tolist() == [1, 2, 3, 4, 4, 5, 5, 6, 16]
    assert (np.diff(toxicity.evidence(np.arange(1, 100_000))) >= 0).all()


def test_maximal_segments():
    pick = np.random.default_rng(8)
    for _ in range(300):
        scores = pick.normal(-0.3, 1, pick.integers(0, 30))
        found = toxicity.maximal_segments(scores)
        sums = {(a, b): scores[a:b].sum() for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        if best := max(sums.values(), default=0) > 0:
            a, b = max(sums, key=sums.get)
            assert any(s[:2] == (a, b) for s in found) and best
        for (_, b, _), (c, _, _) in zip(found, found[1:], strict=False):
            assert b <= c
        for a, b, s in found:
            assert np.isclose(s, scores[a:b].sum()) and s > 0
            assert all(scores[a:k].sum() > 0 and scores[k:b].sum() > 0 for k in range(a + 1, b))


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.report(docs, labels, shared.staging(spark)).collect()
    assert len(found) == len(rows()) and all(0 <= r.score <= 1 and not r.passages for r in found)


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><h1>A &amp; b</h1>
    <p>One<br>two<p>Next  para<div style="display: none">no</div><div hidden>no</div><ul><li>a<li>b<ul><li>c</ul></ul>
    <ol start=3><li>x<li>y</ol><table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3</table><pre>  keep
  this</pre>1 < 2"""
    assert html.render(page) == (
        "A & b\n\nOne\ntwo\n\nNext para\n\n- a\n- b\n\n  - c\n\n3. x\n4. y\n\nName       Qty\nApple pie  3\n\n  keep\n  this\n\n1 < 2"
    )
    assert [html.render(x) for x in ("", "<p>", "plain", "<!-- x", "<script>x", "</b>t")] == ["", "", "plain", "", "", "t"]
    assert html.render("<div>" * 5000 + "deep") == "deep"


def test_html_nested_deep():
    inner = "a<script>s</script><style>s</style><iframe>s</iframe><b hidden>s</b><p style='display:none'>s</p><div>b</div>c"
    for outer in ("<div>", "<font>", "<section><span>"):
        assert html.render(outer * 50_000 + inner) == "a\nb\nc"
    assert html.render("<b>" * 300 + "<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>long<td>4</table>") == "- a\n- b\n\n1     2\nlong  4"
    assert html.render("<ul><li>" * 30_000 + "x") == "- " * 30_000 + "x"
    assert html.render("<ul><li>x" * 20_000).count("x") == 20_000
    assert html.render("<pre>" + "<i>" * 50_000 + " y") == " y"


def test_html_tables_keep_columns():
    words = " ".join(["word"] * 20)
    lines = html.render(f"<table><tr><td>a<td>{words}<td>b<tr><td>c<td>d<td>{words}</table>").split("\n")
    part = " ".join(["word"] * 8)
    assert lines == [f"a  {part}  b", f"   {part}", "   word word word word", f"c  d{' ' * (len(part) + 1)}{words}"]
    assert html.render(f"<table><tr><td>{'y' * 90}<td>b</table>") == f"{'y' * 40}  b\n{'y' * 40}\n{'y' * 10}"
    rows = "<tr><td>x" * 300
    assert html.render(f"<table><tr><td rowspan=301>a<td>x{rows}<tr><td>b</table>") == "a  x\n" + "   x\n" * 300 + "b"
    assert html.render("<table><tr><td rowspan=0>a<td>x<tr><td>y<tbody><tr><td>b</table>") == "a  x\n   y\nb"
    assert html.render("<table><tr><td colspan=150>a<td>b<tr>" + "<td>c" * 151 + "</table>") == "a" + " " * 449 + "b\n" + "  ".join("c" * 151)


def test_html_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a<p>b"), (1, "u", None), (None, None, "")], "page_id long, url string, html string")
    assert Counter(tuple(r) for r in html.extracted(pages).collect()) == {(1, "a\n\nb", 3, 4): 1, (1, "", 0, 0): 1, (None, "", 0, 0): 1}


def test_cleaning_keeps_columns_and_good_lines(docs):
    kept = quality.cleaned(docs)
    assert kept.columns == docs.columns and {r.verdict for r in kept.collect()} <= {"v", None}
    assert not any("Login" in r.text for r in kept.collect())
    assert any("cookie policy" in r.text for r in kept.collect())  # at the end of a long line
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in kept.collect())


def test_mix_repeats_whole_documents(spark, docs):
    mixed = mixing.repeated(docs, shared.staging(spark))
    assert mixed.columns == docs.columns
    taken = Counter(r.doc_id for r in mixed.collect())
    report = Counter()
    for r in mixing.report(docs, shared.staging(spark)).collect():
        report[r.doc_id] += r.taken // max(1, r.size)
    sized = {r.doc_id for r in mixing.report(docs, shared.staging(spark)).where("size > 0").collect()}
    assert {i: taken[i] for i in sized} == {i: report[i] for i in sized}


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    left = quality.cleaned(docs).collect()
    best: dict = {}
    place = lambda r: (r.doc_id is not None, r.doc_id)
    for r in left:
        key = r.text.translate(shared.ASCII_LOWER)
        best[key] = max(best.get(key, r), r, key=place)
    group = list(best.values())
    prints = [simhash.fingerprint(r.text.encode()) for r in group]
    label = list(range(len(group)))
    for _ in group:
        label = [min(label[j] for j in range(len(group)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(group))]
    stays = [min((r for r, x in zip(group, label, strict=True) if x == k), key=lambda r: (r.doc_id is None, r.doc_id)) for k in set(label)]
    mixed = mixing.repeated(spark.createDataFrame(stays, docs.schema), shared.staging(spark))
    assert found == Counter(tuple(r) for r in bpe.report(mixed, TOKENIZER).collect()) and found


def test_pipeline_of_an_empty_table(spark, docs, tmp_path):
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_empty_tables(spark, docs):
    none, store = docs.where("false"), shared.staging(spark)
    stored = store.write(none, "none")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for frame in (
        pii.report(stored), substring.report(stored), tokenfile.report(stored, store, TOKENIZER), quality.report(stored),
        simhash.report(stored, store), bpe.report(stored, TOKENIZER), exact.report(stored, store), mixing.report(stored, store),
        toxicity.report(stored, labels, store), quality.cleaned(stored), exact.kept(stored, store), simhash.kept(stored, store),
        mixing.repeated(stored, store), html.extracted(stored.selectExpr("doc_id AS page_id", "text AS html")),
    ):
        assert frame.count() == 0
