"""Information-theoretic sanitisation of personal data.

Base spans (e-mail and network addresses, card and phone numbers) are the protected entities.  Over the
whole corpus, documents are counted that hold an entity e, a term t, and t within `WINDOW` words of e.
What t leaves open about e is IC(e) - PMI(e; t) = -log2 p(e | t) bits, where p is the lower Wilson bound, at
`CONFIDENCE` standard deviations, of the share of t's documents with e beside it: one estimate for all counts,
the same in a table of any size.  A single sighting leaves 2.28 bits open and so is no evidence at 2 bits.

What is beside an entity is held against a background: for every entity a random place of the same document
stands for a decoy, whose terms are counted and scored alike.  A score is evidence only where the decoys, for as many
terms, give at most `most_false` of the pairs that the entities give at that score or a better one.  Words that point to
their document, or to its copies, but have nothing to do with the entity are as common beside decoys, and stay.

Beside an entity, terms that leave at most `generalise_at` bits open are generalised, and those that leave at
most `remove_at` bits are removed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, distinct_pairs, mix, span_hashes, steps, stored, text_buffer, word_spans
from .features import NOT_ALNUM, runs, text_steps

WINDOW = 5
CONFIDENCE = 1.96
#: Steps of a bit by which scores are held against the background.
LEVELS = 8
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails from its start fails from every later digit as well.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = np.zeros(256, bool)
_HINT[[*range(48, 58), 64]] = True


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of a local part, @ and a domain with a dot, without a new search from every letter."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted; kinds are places in KINDS."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _near(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """(entity, term, start, end) for the terms within WINDOW words of each span; (entity, term) for those at a random place.

    A decoy's place follows from the entity and the number of terms, so copies of a text have it at the same place;
    terms within reach of some span are left out of it.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    low = LOWER[raw]
    starts, ends, _ = word_spans(low, np.array([0, len(raw)]), NOT_ALNUM)
    term = span_hashes(low, starts, ends)
    if len(raw) != len(text):
        point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        starts, ends = point[starts], point[ends]
    edges = np.array([(s, e) for s, _, e in spans])
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, np.searchsorted(ends, edges[:, 0], "right"), 1)
    np.add.at(cover, np.searchsorted(starts, edges[:, 1], "left"), -1)
    free = (ends - starts >= 3) & (np.cumsum(cover[:-1]) == 0)
    term, starts, ends = term[free].view(np.int64), starts[free], ends[free]
    out, entities, reached = [], [], np.zeros(len(term), bool)
    for s, kind, e in spans:
        value = text[s:e].lower() if kind < 2 else "".join(filter(str.isdigit, text[s:e]))
        raw_value = np.frombuffer(value.encode(), np.uint8)
        entity = int(mix(span_hashes(raw_value, np.array([0]), np.array([len(raw_value)])) + np.uint64(kind)).view(np.int64)[0])
        at = int(np.searchsorted(starts, s))
        lo, hi = max(0, at - WINDOW), at + WINDOW
        reached[lo:hi] = True
        entities.append(entity)
        out += [(entity, *x) for x in zip(term[lo:hi].tolist(), starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict=True)]
    decoys = []
    for entity in entities if len(term) else ():
        at = (entity ^ 0x5DEECE66D) % len(term)
        lo, hi = max(0, at - WINDOW), at + WINDOW
        decoys += [(entity, t) for t, near in zip(term[lo:hi].tolist(), reached[lo:hi].tolist(), strict=True) if not near]
    return out, decoys


_FOUND = "doc_id long, text_key long, base array<struct<start:int,kind:int,end:int>>, near array<struct<entity:long,term:long,start:int,end:int>>, decoys array<struct<entity:long,term:long>>"
_BASE_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_NEAR_TYPE = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))
_DECOY_TYPE = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))


def _by_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about STEP_BYTES of text, so that what is made of them stays as small."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(batch.schema.get_field_index("text")))
        for lo, hi in steps(offsets):
            yield batch.slice(lo, hi - lo)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _by_steps(batches):
        texts = batch.column(batch.schema.get_field_index("text"))
        buf, offsets = text_buffer(texts)
        base, near, decoys = ([[] for _ in range(batch.num_rows)] for _ in range(3))
        hints = np.searchsorted(np.flatnonzero(_HINT[buf]), offsets)
        for i in np.flatnonzero(np.diff(hints)).tolist():
            text = texts[i].as_py()
            base[i] = base_spans(text)
            near[i], decoys[i] = _near(text, base[i]) if base[i] else ([], [])
        keys = [{"start": s, "kind": k, "end": e} for x in base for s, k, e in x]
        terms = [{"entity": n, "term": t, "start": s, "end": e} for x in near for n, t, s, e in x]
        others = [{"entity": n, "term": t} for x in decoys for n, t in x]
        lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(flat, kind.value_type)) for x, flat, kind in ((base, keys, _BASE_TYPE), (near, terms, _NEAR_TYPE), (decoys, others, _DECOY_TYPE))]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text_key")] + lists, ["doc_id", "text_key", "base", "near", "decoys"])


def _document_frequencies(batches: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """term and the number of documents that hold it, added up within a task over most pairs or a step's at a time."""
    parts: list[np.ndarray] = []
    held = 0

    def out() -> pa.RecordBatch:
        value, n = runs(np.concatenate(parts))
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], ["term", "n"])

    for batch in batches:
        for _, _, buf, offsets in text_steps(batch):
            low = LOWER[buf]
            starts, ends, row = word_spans(low, offsets, NOT_ALNUM)
            long = ends - starts >= 3
            _, term = distinct_pairs(row[long], span_hashes(low, starts[long], ends[long]))
            parts.append(term)
            held += len(term)
            if held > most:
                yield out()
                parts, held = [], 0
    if held:
        yield out()


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and base spans of every row, with the terms near them; stored in the shared folder."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return stored(keyed.mapInArrow(_find, _FOUND), "personal-data")


def _lower_bound(k: Column, n: Column) -> Column:
    """The lower Wilson bound of a share counted as k of n."""
    p, z2 = k / n, CONFIDENCE**2
    return (p + z2 / (2 * n) - CONFIDENCE * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def disclosures(docs: DataFrame, found: DataFrame, most: float = 2.0) -> DataFrame:
    """entity, term, bits, false_share of the pairs that leave at most so many bits open, over all docs.

    false_share is how many of the pairs that leave no more bits open are to be expected at random places.
    """
    pair = lambda c: F.transform(c, lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term")))
    each = lambda c, real: found.select(F.explode(F.array_distinct(pair(c))).alias("x"), F.lit(real).alias("real"))
    pairs = each("near", True).union(each("decoys", False)).groupBy("x.entity", "x.term", "real").agg(F.count("*").alias("n_both"))
    pairs = stored(pairs, "term-pairs")
    counted = docs.select("text").mapInArrow(_document_frequencies, "term long, n long")
    n_term = counted.groupBy("term").agg(F.sum("n").alias("n_term"))
    bits = -F.log2(_lower_bound(F.col("n_both"), F.col("n_term")))
    scored = stored(pairs.join(n_term, "term").select("entity", "term", "real", bits.alias("bits")).withColumn("level", F.ceil(F.col("bits") * LEVELS)), "scored-pairs")
    # By level: at most most * LEVELS + 2 rows, the last for all pairs beyond.
    levels = scored.groupBy(F.least("level", F.lit(int(most * LEVELS) + 1)).alias("level")).agg(F.count_if("real").alias("real"), F.count_if(~F.col("real")).alias("decoy"))
    upto, all_levels = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    per_term = F.sum("real").over(all_levels) / F.nullif(F.sum("decoy").over(all_levels), F.lit(0))
    share = F.least(F.lit(1.0), F.sum("decoy").over(upto) * F.coalesce(per_term, F.lit(0.0)) / F.sum("real").over(upto))
    shares = levels.select("level", F.coalesce(share, F.lit(1.0)).alias("false_share"))
    return scored.filter(F.col("real") & (F.col("bits") <= most)).join(F.broadcast(shares), "level").select("entity", "term", "bits", "false_share")


def all_spans(docs: DataFrame, generalise_at: float = 2.0, remove_at: float = 1.0, most_false: float = 0.1) -> DataFrame:
    """doc_id, text_key, base, spans: one row for each row of docs(doc_id, text, ...).

    base and spans are arrays of (start, kind, end), sorted; kind is a place in KINDS, and positions are
    code points with the end exclusive.  Null and empty texts have no spans.  Rows that share doc_id and
    text have the same spans and count as often as they stand there.  A null doc_id is a value like any
    other.  Other columns are ignored; an empty table gives an empty result.
    """
    found = find(docs)
    risky = disclosures(docs, found, max(generalise_at, remove_at)).filter(F.col("false_share") <= most_false)
    near = found.select("doc_id", "text_key", F.explode("near").alias("x")).select("doc_id", "text_key", "x.entity", "x.term", "x.start", "x.end")
    action = F.when(F.col("bits") <= remove_at, KINDS.index("remove")).when(F.col("bits") <= generalise_at, KINDS.index("generalise"))
    hits = near.join(risky, ["entity", "term"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max(action).alias("kind")).filter("kind is not null")
    span = F.struct(F.col("start"), F.col("kind").cast("int").alias("kind"), F.col("end"))
    more = hits.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(F.collect_list(span).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    joined = found.join(more, (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    return joined.select("doc_id", "text_key", "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _level_above(term: str) -> str:
    """The class that a generalised term is replaced by."""
    return "[NUMBER]" if any(map(str.isdigit, term)) else "[NAME]" if term[:1].isupper() else "[WORD]"


def _rewrite(text: str, spans: list[dict]) -> str:
    """Spans that overlap are replaced as one, by the mark of the first."""
    out, done = [], 0
    for x in spans:
        if x["end"] <= done:
            continue
        if x["start"] >= done:
            kind = KINDS[x["kind"]]
            mark = "" if kind == "remove" else _level_above(text[x["start"] : x["end"]]) if kind == "generalise" else f"[{kind.upper()}]"
            out += [text[done : x["start"]], mark]
        done = x["end"]
    return "".join([*out, text[done:]])


def _sanitise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _by_steps(batches):
        at, by = batch.schema.get_field_index("text"), batch.num_columns - 1
        texts, spans = batch.column(at).to_pylist(), batch.column(by).to_pylist()
        texts = [_rewrite(t, s) if t and s else t for t, s in zip(texts, spans, strict=True)]
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """docs with personal data and what reveals it replaced in text, in docs' own columns.

    Base spans become [EMAIL], [IP], [CARD] or [PHONE]; terms to be generalised become their class, [NUMBER],
    [NAME] or [WORD], and those to be removed go.  A null text stays null.  Repeated rows stay and are
    treated alike; columns of any name may stand in docs; an empty table gives an empty one.
    """
    doc_id, key, found = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "key", "spans"))
    spans = all_spans(docs, **thresholds).filter("size(spans) > 0")
    spans = spans.select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(key), F.col("spans").alias(found)).dropDuplicates([doc_id, key])
    joined = docs.join(spans, (F.xxhash64("text") == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)), "left")
    return joined.select(*docs.columns, found).mapInArrow(_sanitise, docs.schema)
