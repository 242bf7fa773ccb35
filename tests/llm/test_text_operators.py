"""The text operators against brute force on small tables with nulls, ties, repeats and long texts."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("stagetime.llm.common")
from stagetime.llm import decontam, license_scan, near_dedup, packing, pii, pivot_search, token_orc  # noqa: E402
from stagetime.llm.common import shared_path  # noqa: E402
from stagetime.llm.tokens import TextEncoder, default_vocabulary  # noqa: E402

DOCS = "doc_id long, text string, bands string, near string, ids int, rep string"


def words(n, seed, pool=400):
    r = random.Random(seed)
    return [f"w{r.randrange(pool)}" for _ in range(n)]


def odd_docs():
    base = words(120, 1)
    near = [*base[:60], "changed", *base[61:]]
    texts = ["", None, "   ", "one two", "One TWO", "one two", " ".join(base), " ".join(base), " ".join(near), " ".join(words(30000, 3, 5000)), "a  b\n\n c\td", "<|endoftext|> x", "naïve café – ☃ don't", " lead", "trail ", "x" * 5000, "12 34,5!!", "line\nline two\n"]
    rows = [(i, t, "b", None, 1, "r") for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, "null id text", None, None, None, None), (3, "another text of id three here", "q", "n", 2, "r")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary())


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_library(tokenizer):
    r = random.Random(4)
    texts = ["".join(r.choice(" \n\tab1.,'sé\x1c") for _ in range(r.randint(0, 14))) for _ in range(1500)] + ["".join(r.choice("  \nabc.,!'’x") for _ in range(r.randint(0, 30))) for _ in range(1500)]
    small = TextEncoder(default_vocabulary(), most_words=50)
    for at in range(0, len(texts), 100):
        for text, got in zip(texts[at : at + 100], small.encode(texts[at : at + 100]), strict=True):
            assert got == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_packing(docs, none, tokenizer):
    rows = packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces[:-1])]).tolist()
        used = sum(p["length"] for p in pieces)
        assert used == pieces[0]["tier"] <= 2048 and used & (used - 1) == 0
    once = {i: t for i, t, *_ in odd_docs() if i not in (3, 6)}
    for doc_id, text in once.items():
        pieces, want = sorted(by_doc[doc_id], key=lambda r: r["start"]), ids_of(tokenizer, text, 1)
        assert [x for p in pieces for x in p["ids"]] == want.tolist() and {p["doc_tokens"] for p in pieces} == {len(want)}
    assert sum(r["length"] for r in rows) == sum(len(ids_of(tokenizer, t, 1)) for _, t, *_ in odd_docs())
    for small in (1024, 16384):
        groups = defaultdict(int)
        held = packing.pack(docs, group_tokens=small).collect() if small < 16384 else rows
        for r in held:
            groups[r["step_group"]] += r["length"]
        assert all(groups[r["step_group"]] == r["group_tokens"] for r in held)
        odd = [g for g, n in groups.items() if n != small]
        tasks = {g >> 32 for g in groups}
        assert len(odd) <= len(tasks) or small < 2048 and all(groups[g] in (2048, *range(small)) for g in odd)
    assert packing.pack(none).count() == 0
    whole = packing.sequences(packing.pack(docs))
    assert whole.filter("size(input_ids) <> tier").count() == 0


def test_token_files(spark, docs, none, tokenizer):
    path = shared_path(spark, "tokens")
    token_orc.write_token_files(docs, path)
    got = sorted(token_orc.digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, *_ in odd_docs()), key=lambda i: (i is not None, i))
    total = 0
    texts = defaultdict(list)
    for i, t, *_ in odd_docs():
        texts[i].append(ids_of(tokenizer, t, 0))
    for r in got:
        assert r["start"] == total
        total += r["n_tokens"]
        assert (r["n_tokens"], r["ids_crc32"]) in {(len(x), zlib.crc32(x.tobytes())) for x in texts[r["doc_id"]]}
    assert [r["ids"] for r in token_orc.find_documents(spark, path, [9]).collect()] == [texts[9][0].tolist()]
    order = np.array([r["start"] for r in got if r["doc_id"] == 3])
    assert len(order) == 2 and spark.read.orc(path).count() == len(odd_docs())
    jvm = spark.sparkContext._jvm
    files = [f for f in spark.read.orc(path).inputFiles() if f]
    kinds, encodings, strides = set(), set(), set()
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(spark.sparkContext._jsc.hadoopConfiguration()))
        strides.add(reader.getRowIndexStride())
        records = reader.rows()
        for stripe in reader.getStripes():
            footer = records.readStripeFooter(stripe)
            kinds |= {(x.getColumn(), x.getKind().toString()) for x in footer.getStreamsList()}
            encodings |= {footer.getColumns(6).getKind().toString()}
        records.close()
    assert {(1, "ROW_INDEX"), (1, "BLOOM_FILTER_UTF8"), (6, "DATA")} <= kinds and encodings == {"DIRECT_V2"} and strides == {2000}
    hot = spark.createDataFrame([(5, f"text {k}") for k in range(4000)] + [(None, "x")] * 50, "doc_id long, text string")
    many = shared_path(spark, "hot")
    token_orc.write_token_files(hot, many)
    starts = token_orc.digests(spark, many).orderBy("start").collect()
    assert len(starts) == 4050 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(starts, starts[1:], strict=False)) and starts[0]["doc_id"] is None
    empty = shared_path(spark, "none")
    token_orc.write_token_files(none, empty)
    assert token_orc.digests(spark, empty).count() == 0


def brute_components(rows, percent):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if rows[a][0] is not None and rows[b][0] is not None and x and y and (rows[a][0] == rows[b][0] or 100 * len(x & y) >= percent * len(x | y)):
                label[root(a)] = root(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        least = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in members]
    return sorted(map(repr, out))


def test_ids_of_several_texts(spark):
    def text(seed, changed=False):
        w = words(100, seed, 10_000)
        return " ".join([*w[:50], "changed", *w[51:]] if changed else w)

    rows = [(k, text(70 + k)) for k in (1, 2, 3)] + [(10, text(70 + k)) for k in (1, 2, 3)]  # 10 stands in three classes
    for i in range(20, 40, 5):  # each text of i has its own near copy
        rows += [(i, text(100 + i + k)) for k in range(3)] + [(i + 1 + k, text(100 + i + k, True)) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])) for r in near_dedup.near_duplicates(docs, 80).collect())
    assert got == brute_components(rows, 80) and len({r.split(", ")[2] for r in got}) == 5


def chain_docs():
    """Groups in which neighbours are alike but the ends aren't, and copies of one base at the threshold."""
    rows, at = [], 100
    for seed in range(4):
        text = words(150, 10 + seed, 10_000)
        for step in range(6):
            text = list(text)
            for k in range(step * 9, step * 9 + 3):
                text[(k * 7) % 150] = f"n{seed}x{step}x{k}"
            rows.append((at, " ".join(text), None, None, None, None))
            at += 1
    base = words(200, 77, 10_000)
    r = random.Random(5)
    for _ in range(25):
        text = list(base)
        for k in r.sample(range(200), r.randint(1, 7)):
            text[k] = f"z{r.randrange(10**6)}"
        rows.append((at, " ".join(text), None, None, None, None))
        at += 1
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rows = odd_docs() + chain_docs()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), percent)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_components(rows, percent)


def test_near_duplicates_of_a_given_table_miss_no_link(spark):
    """Recall of all links of the given small table, and what each round finds of the classes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    holders, sets = defaultdict(list), {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
        for x in sets[i]:
            holders[x].append(i)
    met = defaultdict(int)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                met[ids[a], ids[b]] += 1
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, b), n in met.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    want = {i: (len(sets[i]), root(i)) for i in sets}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, 85).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got)


def test_without_near_duplicates(spark, docs, none):
    kept = near_dedup.without_near_duplicates(docs).collect()
    ids = [r["doc_id"] for r in kept]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert {6, 9, None} <= set(ids) and not {7, 8} & set(ids)
    assert near_dedup.without_near_duplicates(none).count() == 0


def brute_leaks(text, items):
    out = []
    for item_id, item in items:
        w = lambda t: re.findall(r"[^\W_]+", t.lower())
        if item and w(item) and f" {' '.join(w(item))} " in f" {' '.join(w(text or ''))} ":
            out.append(item_id)
    return sorted(out)


def test_decontamination(spark, none):
    items = [(k, " ".join(words(12 + 3 * k, 500 + k, 3000)) + ". " + " ".join(words(6, 700 + k, 3000)) + ".") for k in range(30)] + [(99, None), (98, ""), (97, "Alone here now.")]
    filler = lambda n, s: " ".join(words(n, s, 3000))
    texts = [f"{filler(n, n)} {items[n][1]} {filler(300 - n, n + 1)}" for n in range(30)] + [filler(5000, 9), None, "", items[5][1].upper(), f"{filler(70, 1)} {items[2][1]} {filler(3, 3)} {items[8][1]}"]
    rows = [(i, t, "b", None, None, None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("leaks", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in decontam.find_leaks(frame, bench).collect()}
    assert got == {i: brute_leaks(t, items) for i, t, *_ in rows}
    clean = decontam.decontaminate(frame.drop("leaks"), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, x in got.items() if not x} and clean.columns == frame.columns[:-1]
    assert decontam.find_leaks(none, bench).count() == 0
    assert decontam.find_leaks(frame, bench.limit(0)).filter("size(leaks) > 0").count() == 0


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute_bm25(texts, items, threshold=0.6, question_least=0.8, answer_least=0.5):
    """For each text, {item text: best score} by scoring every passage against every item."""
    import math
    from collections import Counter

    items = [(t, Counter(plain_words(t))) for t in sorted({t for t in items if t and plain_words(t)})]
    df = Counter(w for _, c in items for w in c)
    sizes = [sum(c.values()) for _, c in items]
    mean, step = sum(sizes) / max(len(sizes), 1), max(32, *sizes)
    impacts = []
    for (_, c), size in zip(items, sizes, strict=True):
        raw = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)) for w, n in c.items()}
        impacts.append({w: x / sum(raw.values()) for w, x in raw.items()})

    def share(part, passage):
        part = plain_words(part)
        n = min(5, len(part))
        if not part:
            return 1.0
        there = {tuple(passage[k : k + n]) for k in range(len(passage) - n + 1)}
        hits = [k for k in range(len(part) - n + 1) if tuple(part[k : k + n]) in there]
        return len({j for k in hits for j in range(k, k + n)}) / len(part)

    out = []
    for text in texts:
        w, best = plain_words(text), {}
        for lo in range(0, len(w), step):
            passage = w[lo : lo + 2 * step]
            there = set(passage)
            for (item, _), impact in zip(items, impacts, strict=True):
                score = sum(x for t, x in impact.items() if t in there)
                if score >= threshold - 1e-9 and score > best.get(item, 0):
                    q, a = (share(x, passage) for x in decontam.question_and_answer(item))
                    if q >= question_least and a >= answer_least:
                        best[item] = score
        out.append(best)
    return out


def test_parts_score_as_one_index_and_as_brute_force(spark):
    r = random.Random(12)
    items = [(k, " ".join(f"t{int(r.paretovariate(0.7)) % 300}" for _ in range(r.randint(4, 40))) + ". " + " ".join(words(r.randint(1, 6), 60 + k, 200)) + ".") for k in range(60)]
    items += [(100, items[3][1]), (None, items[4][1]), (101, None), (102, "")]
    texts = []
    for k in range(120):
        w = items[k % 60][1].split()
        gone = set(r.sample(range(len(w)), int(len(w) * r.choice([0, 0.1, 0.3, 0.5]))))
        texts.append(" ".join([*words(r.randint(0, 90), k, 300), *(x for i, x in enumerate(w) if i not in gone), *words(r.randint(0, 40), k + 1, 300)]))
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (None, None)], "doc_id long, text string").withColumn("row", F.lit(1)).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    loose = {"question_least": 0.3, "answer_least": 0.0}
    by_text = defaultdict(list)
    for i, t in items:
        by_text[t].append(i)
    for settings in ({}, loose):
        want = [{i: s for t, s in x.items() for i in by_text[t]} for x in brute_bm25([*texts, texts[0], None], [t for _, t in items], **settings)]
        for index_bytes in (1 << 25, 800):
            got = decontam.find_leaks(docs, bench, index_bytes=index_bytes, **settings)
            assert got.columns == ["doc_id", "text", "row", "leaks"]
            rows = sorted(got.collect(), key=lambda x: (x["doc_id"] is None, x["doc_id"]))
            expected = sorted(zip([*range(120), 0, None], want, strict=True), key=lambda x: (x[0] is None, x[0]))
            assert [x["doc_id"] for x in rows] == [i for i, _ in expected]
            for x, (_, leaks) in zip(rows, expected, strict=True):
                ids = [y["item_id"] for y in x["leaks"]]
                assert set(ids) == set(leaks) and len(ids) == len(leaks) and ids == sorted(ids, key=lambda i: (i is not None, i or 0))
                assert all(abs(y["score"] - leaks[y["item_id"]]) < 1e-9 for y in x["leaks"])
        assert sum(map(len, want)) > 20


def test_block_max_wand_equals_full_scoring():
    r = random.Random(8)
    texts = [" ".join(f"t{int(r.paretovariate(0.6)) % 80}" for _ in range(r.randint(3, 30))) for _ in range(400)]
    index = decontam.ItemIndex([[i] for i in range(400)], texts)
    for _ in range(40):
        terms = sorted(r.sample(range(len(index.terms)), min(20, len(index.terms))))
        score = defaultdict(float)
        for t in terms:
            for item, impact in zip(*index.postings(t)[:2], strict=True):
                score[item] += impact
        for threshold in (0.2, 0.5, 0.8):
            want = {i for i, s in score.items() if s >= threshold - 1e-9}
            assert {i for i, _ in index.search(terms, threshold)} == want


def test_base_spans_equal_plain_patterns():
    def brute(t):
        out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = [int(c) for c in m[0] if c.isdigit()][::-1]
            if 12 <= len(d) <= 19 and (sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0:
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        return sorted(out)

    r = random.Random(3)
    for _ in range(20000):
        t = "".join(r.choice("ab1.2-@+ 0(5).é%") for _ in range(r.randint(1, 40)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000 + " 1.2.3.4")[-1][1] == 1


def pii_rows():
    rows = [(i, f"say {'secretword a.b@mail.example.com' if i < 6 else 'plainly nothing'} and common filler ünder {i}", None, None, None, None) for i in range(12)]
    return [*rows, rows[0], (50, None, None, None, None, None), (51, "", None, None, None, None), (None, "id 10.1.2.3 here", None, None, None, None), (52, "card 4041894974608795 +1 (414) 555-3519 " + "lorem " * 20000, None, None, None, None)]


def lower_bound(k, n):
    p, z = k / n, 1.96
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def plain_disclosure(rows):
    """bits by (entity, term) for pairs and decoys, and the pairs' places in the texts, all by counting."""
    tokens = lambda t: [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", t or "")]
    with_term, near, decoys, places = defaultdict(int), defaultdict(int), defaultdict(int), []
    for i, t, *_ in rows:
        base = pii.base_spans(t or "")
        free = [x for x in tokens(t) if len(x[2].encode()) >= 3 and all(x[1] <= s or x[0] >= e for s, _, e in base)]
        for w in {x[2] for x in tokens(t)}:
            with_term[w] += 1
        found, reached, others = pii._near(t, base)[0] if base else [], set(), set()
        entity = iter(dict.fromkeys(x[0] for x in found))
        keys, pairs = {}, set()
        for s, _, e in base:
            k = sum(x[0] < s for x in free)
            window = range(max(0, k - 5), min(len(free), k + 5))
            reached |= set(window)
            keys[t[s:e]] = keys.get(t[s:e]) or (next(entity) if window else None)
            pairs |= {(t[s:e], free[j][2]) for j in window}
            places += [(i, t[s:e], free[j]) for j in window]
        for name, key in keys.items():
            at = (key ^ 0x5DEECE66D) % len(free) if key is not None else 0
            others |= {(name, free[j][2]) for j in range(max(0, at - 5), min(len(free), at + 5)) if j not in reached}
        for counts, some in ((near, pairs), (decoys, others)):
            for x in some:
                counts[x] += 1
    bits = lambda counts: {x: -math.log2(lower_bound(k, with_term[x[1]])) for x, k in counts.items()}
    return bits(near), bits(decoys), places


def test_disclosure_equals_counting(spark, none):
    r = random.Random(3)
    filler = lambda n: " ".join(f"filler{r.randrange(4000)}" for _ in range(n))
    rows = pii_rows()
    # Two documents of each person, most with a word of their own beside the address.
    for k in range(20):
        rows += [(100 + 2 * k + j, f"{filler(30)} {'name%d' % k if k % 4 else filler(1)} p{k}@mail.example.com {filler(30)} once{k} more", None, None, None, None) for j in range(2)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {(x["doc_id"], x["text_key"]): [tuple(s) for s in x["spans"]] for x in pii.all_spans(docs).collect()}
    texts = {x["doc_id"]: x["k"] for x in docs.select("doc_id", F.xxhash64("text").alias("k")).collect()}
    near, decoys, places = plain_disclosure(rows)

    def false_share(bits):
        level = math.ceil(bits * pii.LEVELS)
        upto = lambda some: sum(math.ceil(b * pii.LEVELS) <= level for b in some.values())
        return upto(decoys) * len(near) / len(decoys) / upto(near)

    want = defaultdict(dict)
    for i, e, (s, end, w) in places:
        if near[e, w] <= 2.0 and false_share(near[e, w]) <= 0.1:
            want[i][s, end] = max(want[i].get((s, end), 0), 5 if near[e, w] <= 1.0 else 4)
    assert {4, 5} == {k for x in want.values() for k in x.values()} and decoys
    for i, t, *_ in rows:
        assert got[i, texts[i]] == sorted([*pii.base_spans(t or ""), *((s, k, e) for (s, e), k in want[i].items())]), i
    clean = {x["doc_id"]: x["text"] for x in pii.sanitise(docs).collect()}
    assert clean[50] is None and clean[51] == "" and "[EMAIL]" in clean[0] and "secretword" not in clean[0] and clean[None] == "id [IP] here" and clean[52].startswith("card [CARD] [PHONE] lorem")
    assert pii.sanitise(docs).count() == len(rows) and pii.sanitise(none).count() == 0
    listed = pii.all_spans(docs).select("doc_id", F.sha2(pii.listed(F.col("base")), 256).alias("h")).collect()
    assert {x["h"] for x in listed if x["doc_id"] == 51} == {hashlib.sha256(b"").hexdigest()}


def test_op9_counts_each_kind_wherever_its_spans_stand(spark, tmp_path):
    from stagetime.llm.queries import op9_information_pii

    texts = ["10.0.0.1 a.b@mail.example.com 10.0.0.2", "4041894974608795 a@x.org b@x.org +1 (414) 555-3519", "+1 (414) 555-3519", None, "", "10.0.0.256 none"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op9_information_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = pii.base_spans(t or "")
        digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert tuple(got[i])[:6] == (i, *(sum(k == kind for _, k, _ in base) for kind in range(4)), digest)
    assert tuple(got[0])[1:5] == (1, 2, 0, 0) and tuple(got[1])[1:5] == (2, 0, 1, 1)


def test_added_spans_beat_random_places(spark):
    """Names beside addresses are evidence, words of copied documents are not, nor is a single sighting."""
    r = random.Random(8)
    filler = lambda n: " ".join(f"filler{r.randrange(30000)}" for _ in range(n))
    copies = [f"{filler(60)} user{k}@mail.example.com {filler(60)}" for k in range(60)]
    named = [f"{filler(60)} person{k} named{k}@mail.example.com {filler(60)}" for k in range(60) for _ in range(2)]
    rows = [(k, t) for k, t in enumerate([*copies, *copies])]
    spans = lambda rows: [(x["doc_id"], s) for x in pii.all_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect() for s in x["spans"] if s["kind"] > 3]
    assert spans(rows) == []
    rows = [(1000 + k, t) for k, t in enumerate(named)]
    found = spans(rows)
    words_ = {rows[i - 1000][1][s["start"] : s["end"]] for i, s in found}
    assert sum(w.startswith("person") for w in words_) == 60 and len(words_) <= 66
    assert spans([(1, "hapaxword a.b@mail.example.com " + filler(30))]) == []


def test_sanitise_whatever_the_columns_are_called(spark):
    docs = spark.createDataFrame(pii_rows(), DOCS).selectExpr("doc_id", "text", "bands as _k", "near as _d", "ids as _spans", "rep as more")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert [pii._level_above(x) for x in ("a1", "Name", "word")] == ["[NUMBER]", "[NAME]", "[WORD]"]


def test_terms_near_many_spans_equal_plain_search():
    r = random.Random(9)
    text = " ".join(r.choice(["alpha", "be", "gamma", "x@y.example", "10.0.0.1", "ünder", "42 4041894974608795", "delta."]) for _ in range(600))
    spans = pii.base_spans(text)
    free = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text) if len(m[0].encode()) >= 3 and all(m.end() <= s or m.start() >= e for s, _, e in spans)]
    want = []
    for s, _, _ in spans:
        k = sum(a < s for a, _ in free)
        want += free[max(0, k - 5) : k + 5]
    assert [x[2:] for x in pii._near(text, spans)[0]] == want and len(spans) > 50


def test_licenses(spark, none):
    notice = license_scan.NOTICES["BSD"][1]
    mit = license_scan.NOTICES["MIT"][2]
    wrapped = "MIT License\n\nCopyright 2021 A Person\n\n" + "\n".join(" ".join(mit.split()[k : k + 12]) for k in range(0, len(mit.split()), 12)).replace("\nThe above", "\n\nThe above")
    rows = [(7, wrapped), (8, "Copyright 2020 X. Licensed under the MIT terms below. Released under the MIT License. See there. " + "more " * 60), (9, wrapped.replace("\n\n", "\n") + "\ncode = 1\n" * 30), (1, "prose\nReleased under the MIT License.\nmore"), (2, notice.replace(" with ", "\nwith ") + "\n\nother"), (3, None), (4, ""), (5, "license"), (5, "Licensed under CC BY-NC 4.0."), (6, "Licensed under the terms of nothing at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit(1))

    def brute(body):
        w = re.sub("[^a-z0-9]+", " ", body.lower()).split()
        mine = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
        for name, k, known in license_scan.notice_table():
            dice = 2 * len(mine & set(known)) / (len(mine) + len(known)) if mine else 0
            if dice >= 0.8:
                yield name, k, dice

    want = []
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            want += [(i, "line", p, *m) for m in brute(line)]
        for p, block in enumerate(re.split("\n[ \t\r]*\n", t or "")):
            want += [(i, "paragraph", p, *m) for m in brute(block)] if "\n" in block.strip(" ") else []
        if re.search("\n[ \t\r]*\n", t or ""):
            want += [(i, "text", 0, *m) for m in brute(t)]
        w = re.sub("[^a-z0-9]+", " ", (t or "").lower()).split()
        found = set()
        for name, k, _ in license_scan.notice_table():
            body = license_scan.NOTICES[name][k]
            for word, before in license_scan.anchor_places(body, 0.8):
                for at in (x - before for x, y in enumerate(w) if y == word):
                    found |= {(i, "window", max(at, 0), *m) for m in brute(" ".join(w[max(at, 0) : max(0, at + len(license_scan._words(body)))])) if m[:2] == (name, k)}
        want += sorted(found)
    assert {("window", "MIT", 2), ("text", "MIT", 2)} <= {(x[1], x[3], x[4]) for x in want} and {x[3] for x in want if x[0] == 8} == {"MIT"} and any(x[0] == 9 for x in want)
    assert sorted(map(tuple, license_scan.scan(docs).collect())) == sorted(want) and len(want) >= 3
    assert license_scan.scan(none).count() == 0


def test_licenses_of_a_long_file_of_notices(spark):
    """Each of several hundred notices in one text is found where it stands, and so are texts of anchors alone scanned."""
    mit, words_ = license_scan.NOTICES["MIT"][2], sorted(set().union(*(license_scan.anchors(b, 0.8) for _, _, b in license_scan.notice_table())))
    length, r = len(license_scan._words(mit)), random.Random(3)
    text = "\n\n".join(f"Component {k}\nCopyright 2020 Someone\n{mit}" for k in range(300))
    docs = spark.createDataFrame([(1, text), (2, " ".join(r.choice(words_) for _ in range(20000)))], "doc_id long, text string")
    got = license_scan.scan(docs).filter("unit = 'window' and notice = 2").collect()
    exact = sorted(x["position"] for x in got if x["dice"] == 1.0)
    assert exact == [5 + k * (length + 5) for k in range(300)] and {(x["doc_id"], x["license"]) for x in got} == {(1, "MIT")}


def test_every_match_has_an_anchor():
    r = random.Random(2)
    for _, _, known in license_scan.notice_table():
        words_ = license_scan.anchors(known, 0.8)
        for _ in range(200):
            kept = r.sample(known, -(-2 * len(known) // 3))
            assert any(w in words_ for b in kept for w in b.split())


def test_pivot_search_of_odd_vectors(spark):
    """Great components, lengths of every kind and rows that repeat an id, against exact whole numbers."""
    import math

    r = random.Random(4)
    rows = [(i, [r.uniform(-1, 1) * 10.0 ** r.choice([0, 6, 12, 30]) for _ in range(r.choice([2, 2, 3]))]) for i in range(120)]
    rows += [(50, [1.0, 2.0]), (50, [1.0, 2.0]), (100, [3.0]), (7, [1.0, 2.0]), (8, []), (9, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(x) for x in pivot_search.top_k(frame, F.col("vec_id") % 50 == 0).collect())
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(map(math.isfinite, v))]
    want = []
    for a, (i, v) in enumerate(whole):
        if i % 50 == 0:
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w, strict=True)))), j) for b, (j, w) in enumerate(whole) if a != b and len(w) == len(v))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores[:5])]
    assert got == sorted(want) and any(abs(x[3]) > 2**62 for x in got)


def test_pivot_search(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 16))
    v = (centres[rng.integers(0, 5, 1500)] + rng.normal(scale=0.2, size=(1500, 16))) * rng.uniform(0.5, 1.5, (1500, 1))
    v[100:400] = v[100]
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)] + [(2000, None), (2001, [float("nan")] * 16), (2002, [None] * 16), (2003, [1.0] * 3), (None, [1.0] * 16), (7, [float(x) for x in v[7]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    got = {tuple(r) for r in pivot_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()}
    whole = np.floor(256 * np.float32(v).astype(float)).astype(np.int64)
    ids = np.append(np.arange(1500), 7)
    whole = np.vstack([whole, whole[7]])
    want = set()
    for q in range(0, 1500, 50):
        score = whole @ whole[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:5]
        want |= {(q, k + 1, int(ids[j]), int(score[j])) for k, j in enumerate(order)}
    assert got == want
    assert pivot_search.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert sorted(map(tuple, pivot_search.top_k(frame.filter("vec_id in (0, 1)"), F.col("vec_id") % 50 == 0).select("query_id", "vec_id").collect())) == [(0, 1)]
