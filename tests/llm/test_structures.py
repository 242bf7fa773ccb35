"""The Merkle manifest, the repair of conversations and the tries of fingerprints against plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("stagetime.llm.common")
from stagetime.llm import merkle, repair, simhash  # noqa: E402


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def in_text_order(rows):
    return sorted(map(tuple, rows), key=str)


# --- Merkle -------------------------------------------------------------------------------------


def plain_leaf(d):
    return hashed(*("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in merkle.FIELDS))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_proofs(docs):
    by_lang = defaultdict(list)
    for d in docs:
        by_lang[d["lang"]].append(d)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, plain_leaf(d)))
        trees[lang] = plain_levels([plain_leaf(d) for d in by_lang[lang]])
    top = plain_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for a, lang in enumerate(langs):
        for i, d in enumerate(by_lang[lang]):
            way = []
            for levels, place in ((trees[lang], i), (top, a)):
                for level in levels[:-1]:
                    way.append((place & 1, level[place ^ 1] if place ^ 1 < len(level) else ""))
                    place >>= 1
            changed = dict(d)
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 and d["n_chars"] is not None:
                changed["n_chars"] += 1
            now = plain_leaf(changed)
            for odd, other in way:
                now = hashed(other, now) if odd else hashed(now, other)
            out.append((d["doc_id"], plain_leaf(d), trees[lang][-1][0], top[-1][0], hashed(*(s for _, s in way)), now, now == top[-1][0]))
    return out


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def test_addresses_are_a_van_emde_boas_order():
    for levels in range(1, 9):
        places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
        assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    # Four levels: the upper two first, then the four subtrees of two levels one after the other.
    assert [merkle.address(4, d, np.arange(1 << d)).tolist() for d in range(4)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


@pytest.mark.parametrize("height", [10, 2, 1])
def test_proofs(spark, height):
    r = random.Random(height)
    rows = [(r.choice([None, *range(60)]), r.choice([None, "", "text", "é ☃", "x" * 50_000]), r.choice([None, "", "en", "de", "zh-é"]), r.choice(["s", None]), r.choice([None, 0, 5, 2**63 - 1]), "clash", b"x") for _ in range(90)]
    rows += [rows[0]] * 3 + [(k, "many", "xx", "s", k, "clash", b"x") for k in range(37)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tree string, nodes binary").repartition(3)
    got, want = in_text_order(merkle.proofs(docs, tampered(), height).collect()), in_text_order(plain_proofs([x.asDict() for x in docs.collect()]))
    assert got == want and any(not x[-1] for x in got) and any(x[-1] for x in got)
    one = docs.filter("text = 'many' and doc_id = 3")
    assert in_text_order(merkle.proofs(one, tampered(), height).collect()) == plain_proofs([x.asDict() for x in one.collect()])
    assert merkle.proofs(docs.limit(0), tampered(), height).collect() == []


def test_manifest_is_stored_in_blocks(spark):
    docs = spark.range(21).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 16, "a").otherwise("b").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    blocks = merkle.Manifest(docs, height=2).table().collect()
    assert sorted((x["lang"] or "", x["top"], x["level"], x["block"], x["leaves"]) for x in blocks) == [("", True, 0, 0, 2), *(("a", False, 0, k, 4) for k in range(4)), ("a", False, 1, 0, 4), ("b", False, 0, 0, 4), ("b", False, 0, 1, 1), ("b", False, 1, 0, 2)]
    assert {len(x["nodes"]) for x in blocks if x["lang"] == "a"} == {7 * 32}
    assert {len(w) for w in merkle.ways(next(x["nodes"] for x in blocks if x["leaves"] == 1), 1, 3)} == {2 * 33}


# --- repair -------------------------------------------------------------------------------------


def plain_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        conv_text, turn_text, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        fault = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def plain_faults(rows):
    rows, seen, out = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest())), set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return rows, out


def plain_repair(rows, faults):
    """Uniform-cost search from the first row on; prefixes are told apart by the initials they have given."""

    def after(seq):
        return None if not re.fullmatch("s?(ua)*u?", seq) else seq if seq in ("", "s") else "u" if seq[-1] == "u" else "ua"

    heap, done, best = [(0, "", 0, "", ())], {}, None
    while heap:
        cost, audit, i, seq, kept = heapq.heappop(heap)
        if (i, seq) in done:
            continue
        done[i, seq] = True
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", seq) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, kept)
        moves = [(2, "I", i, f"{r}:", r) for r in ("user", "assistant")]
        if i < len(rows):
            _, _, role, text = rows[i]
            more = faults[i] == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, seq, kept))
            if faults[i] not in ("blank", "duplicate"):
                moves += [(more, "K", i + 1, f"{role}:{text}", role), *((2 + more, "R", i + 1, f"{r}:{text}", r) for r in ("user", "assistant"))]
        for price, letter, place, line, role in moves:
            state = after(seq + role[:1])
            if state is not None:
                heapq.heappush(heap, (cost + price, audit + letter, place, state, (*kept, line)))
    return best


def plain_verdicts(rows):
    struck, out = plain_damage(rows), []
    for conv in dict.fromkeys(r[0] for r in rows):
        own, faults = plain_faults([r for r in struck if r[0] == conv])
        turns = [r[1] for r in own if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = plain_repair(own, faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashed("\n".join(kept))))
    return out


def odd_conversations():
    r = random.Random(7)
    role, text = ["user", "assistant", "system", "user", "assistant", "tool", "", None], ["hello.", "what", "", "  ", "x!\n", "end? ", None, "é ü ☃.", "same.", "y" * 20_000 + "."]
    rows = [(r.choice([*range(1, 20), None]), r.choice([None, *range(12)]), r.choice(role), r.choice(text), "clash") for _ in range(150)]
    rows += [(99, k % 300, r.choice(role), r.choice(text), "clash") for k in range(400)]
    return rows + [(50, 3, "user", "a.", "clash")] * 7 + [(60, None, None, None, None)]


@pytest.mark.parametrize("block", [512, 7, 1])
def test_repair(spark, block):
    rows = odd_conversations()
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at string").repartition(3)
    assert in_text_order(repair.repaired_damage(conversations, block).collect()) == in_text_order(plain_verdicts(rows))
    assert repair.repaired_damage(conversations.limit(0), block).collect() == []


def test_repair_in_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = odd_conversations()
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at string").toArrow()  # noqa: F841
    assert in_text_order(duckdb.sql(repair.repaired_damage_sql()).fetchall()) == in_text_order(plain_verdicts(rows))


def test_repaired_rows_fit_the_grammar(spark):
    made = repair.Repair(spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "user", "b."), (2, 0, "system", "s."), (2, 1, "user", "u."), (2, 2, "user", "v."), (2, 3, "assistant", "cut")], "conv_id long, turn long, role string, text string"))
    assert sorted((r["conv_id"], r["audit"], r["cost"]) for r in made.verdicts.collect()) == [(1, "IKKI", 4), (2, "KKIKK", 3)]
    rows = [tuple(r) for r in made.repaired().orderBy("conv_id", "at", "place").select("conv_id", "edit", "role", "text").collect()]
    assert rows == [(1, "I", "user", ""), (1, "K", "assistant", "a."), (1, "K", "user", "b."), (1, "I", "assistant", ""), (2, "K", "system", "s."), (2, "K", "user", "u."), (2, "I", "assistant", ""), (2, "K", "user", "v."), (2, "K", "assistant", "cut")]


# --- SimHash ------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_classes(rows):
    fps = [plain_fingerprint(r[1]) for r in rows]
    known = [k for k, r in enumerate(rows) if r[0] is not None]
    parent = {rows[k][0]: rows[k][0] for k in known}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {k: 0 for k in known}
    for a, i in enumerate(known):
        for j in known[a + 1 :]:
            near = (fps[i] ^ fps[j]).bit_count() <= 2
            if near or rows[i][0] == rows[j][0]:
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
            links[i] += near
            links[j] += near
    return [(r[0], f"{fps[k]:016x}", find(r[0]) if r[0] is not None else None, links.get(k)) for k, r in enumerate(rows)]


def test_fingerprints_equal_plain_ones_and_spark_hashes(spark):
    r = random.Random(2)
    texts = [None, "", " \t", "one", "One TWO", "a b c", "A  b\tc d\n e", " é ü ß x y\x0bz", " ".join(r.choices("abcdefg", k=3000)), *(" ".join(r.choices(["the", "of", "Ünï", "x1"], k=k)) for k in (254, 257, 258, 600))]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert {x["doc_id"]: x["fp"] & (1 << 64) - 1 for x in simhash.fingerprints(docs).collect()} == {k: plain_fingerprint(t) for k, t in enumerate(texts)}
    # Without words in upper case or other separators than a space, Spark's own xxhash64 is that of a shingle.
    assert spark.range(1).select(F.xxhash64(F.lit("of Ünï x1"))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest("of Ünï x1".encode(), 42)


@pytest.mark.parametrize("group", [4096, 3])
def test_trie_pairs_equal_all_pairs(spark, group):
    r = random.Random(5)
    values = {0}
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(25):
            values.add(base ^ sum({1 << r.randrange(64) for _ in range(r.randrange(4))}))
    values = sorted(values)
    signed = [simhash._signed(v) for v in values]
    classes = spark.createDataFrame([(v, k, 1 + k % 3) for k, v in enumerate(signed)], "fp long, rep long, n long")
    from stagetime.llm.common import Scratch

    linked = simhash._linked(classes, Scratch(spark), group).collect()
    met = defaultdict(int)
    for x in linked:
        met[x["fp"]] += x["met"]
    want = {signed[i]: sum(1 + j % 3 for j, w in enumerate(values) if i != j and (v ^ w).bit_count() <= 2) for i, v in enumerate(values)}
    assert dict(met) == {k: n for k, n in want.items() if n}


def simhash_rows():
    r = random.Random(11)
    base = r.choices([f"w{k}" for k in range(50)], k=400)
    texts = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(0, 400, 9)]
    texts += ["", None, " ", "one two", "ONE  two", "other words here", "x" * 300_000, " ".join(base)] * 2
    rows = [(k, t, "clash") for k, t in enumerate(texts)]
    return [*rows, rows[4], (None, "nameless", "c"), (None, "one two", "c"), (3, "a third text of three", "c"), (3, "other words here", "c"), (7, "one two", None)]


@pytest.mark.parametrize("group", [4096, 2])
def test_near_duplicates_by_simhash(spark, group):
    rows = simhash_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    got = in_text_order(simhash.near_duplicates(docs, group).collect())
    assert got == in_text_order(plain_classes(rows)) and len({x[2] for x in got}) < len({x[1] for x in got})
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
