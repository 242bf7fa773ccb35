"""Registered queries of catalogues and cells: aliases in force, talent decisions, the register, polymorphic cells, ids that grow, ties, composite keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audits, decisions, intervals, model
from ..sources import boards
from .binding import MODEL, events_sql, read, status_events
from .queries import query

# --- decisions as of a cut ------------------------------------------------------------------------

_AT = 25
#: What is decided on the k-th of six kinds of aliases: (when, identity suffix, kind, status).
_DECIDED = {1: [(10, "a", "person", "approved"), (20, None, "unknown", "quarantined")], 2: [(10, "b", "organisation", "approved")], 3: [(30, "c", "person", "approved")], 4: [(5, None, "unknown", "pending"), (15, "d", "person", "approved")], 5: [(10, None, "unknown", "quarantined"), (20, "e", "person", "approved")]}


def _aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_type, text, exclusive, item: names of parts, some in capitals and some blank."""
    k = F.col("p_partkey")
    text = F.when(k % 29 == 0, " ").when(k % 3 == 0, F.concat(F.lit(" "), F.upper("p_name"))).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select(k.alias("item"), F.when(k % 2 == 1, "talent").otherwise("brand").alias("entity_type"), text.alias("text"), (k % 4 < 2).alias("exclusive"))


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("source_key")).agg((F.min("p_partkey") % 6).alias("k"))
    entries = [F.struct(F.lit(k).alias("k"), F.lit(at).cast("long").alias("decided_at"), F.lit(i).cast("string").alias("i"), F.lit(kind).alias("entity_kind"), F.lit(status).alias("review_status")) for k, some in _DECIDED.items() for at, i, kind, status in some]
    rows = keys.select("source_key", F.explode(F.filter(F.array(*entries), lambda e: e["k"] == F.col("k"))).alias("e")).withColumn("entity_type", F.explode(F.array(F.lit("talent"), F.lit("brand"))))
    identity = F.when(F.col("e.i").isNotNull(), F.concat("e.i", F.lit(":"), "source_key"))
    return rows.select("entity_type", "source_key", identity.alias("canonical_id"), F.when(F.col("e.i").isNotNull(), F.initcap("source_key")).alias("canonical_name"), "e.entity_kind", "e.review_status", "e.decided_at")


_VALUES = ", ".join(f"({k}, {at}, {repr(i) if i else 'NULL'}, '{kind}', '{status}')" for k, some in _DECIDED.items() for at, i, kind, status in some)
_NAMED = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_FORCE = f"""al AS (SELECT p_partkey AS item, CASE WHEN p_partkey % 2 = 1 THEN 'talent' ELSE 'brand' END AS entity_type, CASE WHEN p_partkey % 29 <> 0 THEN p_name END AS source_key, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS clean, p_partkey % 4 < 2 AS exclusive FROM part),
ks AS (SELECT p_name AS source_key, min(p_partkey) % 6 AS k FROM part GROUP BY 1),
de AS (SELECT entity_type, source_key, CASE WHEN i IS NOT NULL THEN i || ':' || source_key END AS canonical_id, CASE WHEN i IS NOT NULL THEN {_NAMED.format('source_key')} END AS canonical_name, kind, status, decided_at
  FROM ks JOIN (VALUES {_VALUES}) v(k, decided_at, i, kind, status) USING (k) CROSS JOIN (VALUES ('talent'), ('brand')) t(entity_type)),
fo AS (SELECT * FROM de WHERE decided_at <= {_AT} QUALIFY row_number() OVER (PARTITION BY entity_type, source_key ORDER BY decided_at DESC) = 1),
rs AS (SELECT al.*, canonical_id, canonical_name, kind, status, CASE WHEN source_key IS NULL THEN 'missing' WHEN status = 'quarantined' THEN 'quarantined' WHEN status = 'approved' AND entity_type = 'talent' AND kind <> 'person' THEN 'not_individual' WHEN status = 'approved' THEN 'approved'
  WHEN entity_type = 'talent' AND NOT exclusive THEN 'pending_review' WHEN exclusive THEN 'exclusive_register' ELSE 'normalised_text' END AS situation FROM al LEFT JOIN fo USING (entity_type, source_key))"""


@query(f"""WITH {_FORCE} SELECT item, entity_type, source_key, situation, CASE WHEN situation = 'approved' THEN canonical_id END AS approved_id, CASE WHEN situation = 'approved' THEN canonical_name WHEN situation IN ('exclusive_register', 'normalised_text') THEN clean END AS identity_name FROM rs""")
def resolved_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names under the decisions in force at 25: some superseded by then, some made only later."""
    got = decisions.resolve(_aliases(spark, sf_dir), _decided(spark, sf_dir), _AT)
    return got.select("item", "entity_type", "source_key", "situation", F.when(F.col("situation") == "approved", F.col("identity_id")).alias("approved_id"), "identity_name")


@query(f"""WITH {_FORCE} SELECT entity_type, source_key, min(clean) AS source_text, count(*) AS uses, 'unknown' AS entity_kind, 'pending' AS review_status, {_AT}::BIGINT AS updated_at FROM al
WHERE source_key IS NOT NULL AND (entity_type, source_key) NOT IN (SELECT (entity_type, source_key) FROM de WHERE decided_at <= {_AT}) GROUP BY 1, 2""")
def pending_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.pending(_aliases(spark, sf_dir), _decided(spark, sf_dir), _AT).withColumn("updated_at", F.col("updated_at").cast("long"))


@query(f"""WITH {_FORCE} SELECT entity_type, source_key, decided_at AS valid_from, lead(decided_at) OVER (PARTITION BY entity_type, source_key ORDER BY decided_at) AS valid_to, status AS review_status FROM de""")
def alias_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.validity(_decided(spark, sf_dir)).select("entity_type", "source_key", "valid_from", "valid_to", "review_status")


_TALENTS = f"""{_FORCE}, sn AS (SELECT p_partkey AS item, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 13 = 1 THEN 'Squad ' || p_name WHEN p_partkey % 13 = 2 THEN p_name || ' & ' || p_brand ELSE p_name END AS talent,
  CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'Various' WHEN 2 THEN p_brand ELSE ' ' END AS other, CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 1 END AS ids FROM part),
te AS (SELECT item, ids, place, lower(trim(text)) AS t, fo.*  FROM (SELECT item, ids, 0 AS place, talent AS text FROM sn UNION ALL SELECT item, ids, 1, other FROM sn) x LEFT JOIN fo ON fo.entity_type = 'talent' AND fo.source_key = lower(trim(text))),
tr AS (SELECT *, coalesce(t, '') <> '' AS here, CASE WHEN coalesce(t, '') = '' THEN 'missing' WHEN status = 'quarantined' THEN 'quarantined' WHEN status = 'approved' AND kind <> 'person' THEN 'not_individual' WHEN status = 'approved' THEN 'approved' WHEN place = 0 THEN 'exclusive_register' ELSE 'pending_review' END AS situation FROM te),
ta AS (SELECT item, any_value(ids) AS ids, count(DISTINCT CASE WHEN here THEN t END) AS names, bool_or(here AND regexp_matches(t, '\\bsquad\\b')) AS sq, bool_or(here AND (t IN ('group', 'various') OR coalesce(status = 'approved' AND kind <> 'person', false))) AS ni,
  bool_or(here AND NOT coalesce(status = 'approved' AND kind = 'person', false) AND contains(t, ' & ')) AS sv, arg_min(place, CASE WHEN here THEN place ELSE place + 2 END) AS p, arg_min(situation, CASE WHEN here THEN place ELSE place + 2 END) AS situation FROM tr GROUP BY item)"""


@query(f"""WITH {_TALENTS} SELECT item, concat_ws(',', CASE WHEN names > 1 THEN 'both_columns' END, CASE WHEN sv OR ids > 1 THEN 'several' END, CASE WHEN sq THEN 'squad' END, CASE WHEN ni THEN 'not_individual' END) AS reasons,
CASE WHEN situation = 'missing' THEN NULL WHEN p = 0 THEN 'talent' ELSE 'other' END AS origin, situation FROM ta""")
def talent_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on people under the decisions in force at 25."""
    k = F.col("p_partkey")
    talent = F.when(k % 7 == 0, F.lit(None)).when(k % 13 == 1, F.concat(F.lit("Squad "), "p_name")).when(k % 13 == 2, F.concat("p_name", F.lit(" & "), "p_brand")).otherwise(F.col("p_name"))
    other = F.when(k % 5 == 0, F.upper("p_name")).when(k % 5 == 1, "Various").when(k % 5 == 2, F.col("p_brand")).otherwise(" ")
    snapshots = read(spark, sf_dir, "part").select(k.alias("item"), talent.alias("talent"), other.alias("other"), F.when(k % 11 == 0, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1"), F.lit("1"))).alias("talent_ids"))
    return decisions.talent_decisions(snapshots, _decided(spark, sf_dir), _AT).select("item", "reasons", "origin", "situation")


# --- the current register -------------------------------------------------------------------------

_REGISTER = "SELECT c_custkey AS item, CASE WHEN c_nationkey % 5 = 0 THEN 2 ELSE 1 END AS board, CASE WHEN c_custkey % 9 = 0 THEN 'v0' ELSE 'v1' END AS contract, CASE WHEN c_custkey % 17 <> 0 THEN c_custkey * 10 END AS captured_at, c_mktsegment AS segment, c_acctbal AS balance FROM customer"
_USERS = f"""WITH u AS (SELECT DISTINCT user_id * 2 AS case_id, user_id * 2 AS item FROM events), g AS ({_REGISTER}), j AS (SELECT u.*, g.*  EXCLUDE (item), coalesce(board = 1 AND contract = 'v1' AND captured_at IS NOT NULL, false) AS sound, g.item IS NOT NULL AS found FROM u LEFT JOIN g USING (item))"""


def _register(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    register = read(spark, sf_dir, "customer").select(k.alias("item"), F.when(F.col("c_nationkey") % 5 == 0, 2).otherwise(1).alias("board_id"), F.when(k % 9 == 0, "v0").otherwise("v1").alias("contract"), F.when(k % 17 != 0, k * 10).alias("captured_at"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    cases = read(spark, sf_dir, "events").select((F.col("user_id") * 2).alias("case_id")).distinct().withColumn("item", F.col("case_id"))
    return decisions.register_projection(cases, register, 1, "v1", ["segment", "balance"])


@query(_USERS + " SELECT case_id, item, CASE WHEN sound THEN segment END AS current_segment, CASE WHEN sound THEN balance END AS current_balance, CASE WHEN sound THEN captured_at END AS current_captured_at FROM j")
def register_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _register(spark, sf_dir)[0]


@query(_USERS + " SELECT case_id, item, CASE WHEN board <> 1 THEN 'other_board' WHEN contract <> 'v1' THEN 'other_contract' ELSE 'no_instant' END AS issue FROM j WHERE found AND NOT sound")
def register_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _register(spark, sf_dir)[1]


# --- cells under each board's own settings --------------------------------------------------------

_SPEC = {"status": ("s1", "status"), "tags": ("d1", "dropdown"), "owner": ("p1", "people"), "note": ("t1", "text")}


def _boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A board for each region, with labels of its own; one has no people, and on one the tags are text."""
    k, name = F.col("r_regionkey"), F.col("r_name")
    labels = lambda **x: F.to_json(F.struct(F.struct(*[v.alias(i.removeprefix("_")) for i, v in x.items()]).alias("labels")))
    column = lambda i, title, kind, settings: F.struct(F.lit(i).alias("id"), F.lit(title).alias("title"), kind.alias("type"), settings.alias("settings_str"))
    status = column("s1", "Status", F.lit("status"), labels(_0=F.concat(F.lit("Open in "), name), _1=F.concat(F.lit("Done in "), name), _2=F.lit("Paused"), _7=F.lit("Never")))
    tags = column("d1", "Tags", F.when(k == 4, "text").otherwise("dropdown"), labels(_1=F.concat(name, F.lit(" one")), _2=F.concat(name, F.lit(" two"))))
    people, note = column("p1", "Owner", F.lit("people"), F.lit("{}")), column("t1", "Note", F.lit("text"), F.lit("{}"))
    return read(spark, sf_dir, "region").select(k.alias("board_id"), F.when(k == 3, F.array(status, tags, note)).otherwise(F.array(status, tags, people, note)).alias("columns"))


def _board_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    index = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2).cast("string")
    q = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    status = F.when(k % 6 == 0, q('{"index":', index, "}")).when(k % 6 == 1, q('{"index":"', index, '"}')).when(k % 6 == 2, q('{"label":{"index":', index, ',"text":"As told ', index, '"}}'))
    status = status.when(k % 6 == 3, q('{"label":{"index":', index, "}}")).when(k % 6 == 4, q('{"label":"Plain ', index, '"}')).otherwise(F.when(k % 12 == 5, '{"index":99}').otherwise("{broken"))
    tags = F.when(k % 4 == 0, '{"ids":[1,2]}').when(k % 4 == 1, '{"ids":["2"]}').when(k % 4 == 2, '{"ids":[3]}').otherwise('{"ids":[]}')
    owner = F.when(k % 3 == 0, '{"personsAndTeams":[{"id":9,"kind":"team"},{"id":5,"kind":"person"}]}')
    note = F.when(k % 5 == 0, F.lit('{"text":"more"}')).when(k % 5 == 1, q('"', F.col("o_orderpriority"), '"')).otherwise("null")
    cell = lambda i, v: F.struct(F.lit(i).alias("id"), v.alias("value"))
    return read(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).cast("int").alias("board_id"), k.alias("item_id"), F.array(cell("s1", status), cell("d1", tags), cell("p1", owner), cell("t1", note)).alias("cells"))


_CELLS = """WITH o AS (SELECT o_orderkey AS item_id, (o_custkey % 5)::INTEGER AS board_id, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS i, o_orderpriority AS pr, r_name AS r FROM orders JOIN region ON r_regionkey = o_custkey % 5),
d AS (SELECT *, CASE i WHEN 0 THEN 'Open in ' || r WHEN 1 THEN 'Done in ' || r ELSE 'Paused' END AS own,
  CASE WHEN board_id = 4 THEN NULL WHEN item_id % 4 = 0 THEN r || ' one + ' || r || ' two' WHEN item_id % 4 = 1 THEN r || ' two' END AS tags, CASE WHEN board_id <> 3 AND item_id % 3 = 0 THEN 'person:5 + team:9' END AS owner,
  CASE item_id % 5 WHEN 0 THEN 'more' WHEN 1 THEN pr END AS note FROM o),
c AS (SELECT *, CASE item_id % 6 WHEN 2 THEN 'As told ' || i WHEN 4 THEN 'Plain ' || i WHEN 5 THEN NULL ELSE own END AS status FROM d)"""


@query(_CELLS + """ SELECT board_id, item_id, status, tags, owner, note, concat_ws(',', CASE WHEN item_id % 6 = 5 THEN 'status' END, CASE WHEN board_id <> 4 AND item_id % 4 = 2 THEN 'tags' END) AS unread FROM c""")
def board_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of six forms on five boards that call the same index differently."""
    return boards.decode_boards(_board_items(spark, sf_dir), _boards(spark, sf_dir), _SPEC)


@query("SELECT r_regionkey AS board_id, CASE r_regionkey WHEN 3 THEN 'owner' ELSE 'tags' END AS field, CASE r_regionkey WHEN 3 THEN 'no_column' ELSE 'other_kind' END AS issue FROM region WHERE r_regionkey IN (3, 4)")
def board_schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.schema_issues(_boards(spark, sf_dir), _SPEC)


@query(_CELLS + """ SELECT r_regionkey AS board_id, x.index, x.label FROM region, LATERAL (SELECT unnest(['0', '1', '2', '7']) AS index, unnest(['Open in ' || r_name, 'Done in ' || r_name, 'Paused', 'Never']) AS label) x WHERE (r_regionkey, x.label) NOT IN (SELECT (board_id, status) FROM c WHERE status IS NOT NULL)""")
def unused_board_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards.unused_labels(_board_items(spark, sf_dir).filter("board_id is not null"), _boards(spark, sf_dir), "s1")


# --- growing ids, ties, composite keys ------------------------------------------------------------

_TURN = 1_705_276_800_000_000  # 2024-01-15 UTC
_GROWN = f""", se AS (SELECT "at" >= {_TURN} AS second, CASE WHEN k % 3 = 0 THEN k % 5 END AS i, CASE WHEN k % 3 = 0 AND "at" >= {_TURN} THEN status || ' renamed' ELSE coalesce(status, ' ') END AS label FROM bound),
gi AS (SELECT second, 'board:status:' || coalesce(i::VARCHAR, 'label_' || substr(sha256(lower(CASE WHEN trim(label) = '' THEN 'No status' ELSE label END)), 1, 16)) AS status_id, CASE WHEN coalesce(trim(label), '') = '' THEN 'No status' ELSE trim(label) END AS label FROM se),
g1 AS (SELECT status_id, min(label) AS label, 1 AS since FROM gi WHERE NOT second GROUP BY 1), g2 AS (SELECT status_id, min(label) AS label, 2 AS since FROM gi WHERE second AND status_id NOT IN (SELECT status_id FROM g1) GROUP BY 1)"""


@query(events_sql(_GROWN + " SELECT status_id, label, lower(label) AS label_key, lower(label) IN ('closed', 'approved', 'declined', 'no return') AS is_terminal, since FROM (SELECT * FROM g1 UNION ALL SELECT * FROM g2)"))
def grown_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the second brings new labels, and other words for indexes that are there already."""
    rows, late = status_events(spark, sf_dir), F.col("at") >= _TURN
    index = F.when(F.col("k") % 3 == 0, F.col("k") % 5)
    label = F.when(index.isNotNull() & late, F.concat("status", F.lit(" renamed"))).otherwise(F.coalesce("status", F.lit(" ")))
    seen = rows.select(late.alias("late"), index.alias("index"), label.alias("label"))
    nothing = spark.createDataFrame([], "status_id string, label string, label_key string, is_terminal boolean, since int")
    first = model.grow(nothing, seen.filter("not late"), "board:status", MODEL.terminal, 1)
    return model.grow(first, seen.filter("late"), "board:status", MODEL.terminal, 2)


_TIED = """, ti AS (SELECT case_id, "at" // 86400000000 AS day, CASE WHEN event_id % 4 = 0 THEN 'x' WHEN event_id % 4 = 1 THEN '007' ELSE (event_id % 4 * 100)::VARCHAR END AS created, CASE WHEN event_id % 3 = 0 THEN 'e' || event_id ELSE event_id::VARCHAR END AS id FROM bound)"""


@query(events_sql(_TIED + """ SELECT case_id, id, row_number() OVER (PARTITION BY case_id ORDER BY day, CASE WHEN created = 'x' THEN 0 ELSE created::BIGINT END, starts_with(id, 'e'), CASE WHEN NOT starts_with(id, 'e') THEN id::BIGINT END, id) AS place FROM ti"""))
def tied_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one day in order of creation times of different form and ids of numbers and texts."""
    n = F.col("event_id")
    created = F.when(n % 4 == 0, "x").when(n % 4 == 1, "007").otherwise((n % 4 * 100).cast("string"))
    rows = status_events(spark, sf_dir).select("case_id", F.floor(F.col("at") / 86_400_000_000).alias("day"), created.alias("created"), F.when(n % 3 == 0, F.concat(F.lit("e"), n.cast("string"))).otherwise(n.cast("string")).alias("id"))
    order = intervals.by_case().orderBy("day", *intervals.tie_order(F.col("created"), F.col("id")))
    return rows.select("case_id", "id", F.row_number().over(order).alias("place"))


_WHO = [f"f{k:02d}" for k in range(1, 15)]


def _side(df: DataFrame, key: str, nation: str, balance: str) -> DataFrame:
    value = lambda k: F.when(F.col(key) % (k + 5) != 0, F.concat(F.lit(f"v{k}-"), (F.round(F.abs(F.col(balance))).cast("long") % (11 * k + 30)).cast("string")))
    name: Column = F.concat(F.lit("item "), (F.col(nation) * 4 + F.round(F.abs(F.col(balance))).cast("long") % 4).cast("string"))
    return df.select(name.alias("name"), *[value(k).alias(f) for k, f in enumerate(_WHO, 1)])


def _side_sql(table: str, p: str) -> str:
    bal = f"round(abs({p}_acctbal))::BIGINT"
    key = {"s": "s_suppkey", "c": "c_custkey"}[p]
    return f"SELECT {key} AS id, 'item ' || ({p}_nationkey * 4 + {bal} % 4) AS name, " + ", ".join(f"CASE WHEN {key} % {k + 5} <> 0 THEN 'v{k}-' || {bal} % {11 * k + 30} END AS {f}" for k, f in enumerate(_WHO, 1)) + f" FROM {table}"


_LONG = "SELECT * FROM (UNPIVOT {0} ON " + ", ".join(_WHO) + " INTO NAME field VALUE value)"
_COMPOSITE = f"""WITH so AS ({_side_sql('supplier', 's')}), sn AS ({_side_sql('customer', 'c')}), lo AS ({_LONG.format('so')}), ln AS ({_LONG.format('sn')}),
com AS (SELECT field, count(*) AS common FROM (SELECT field, value FROM lo GROUP BY ALL) JOIN (SELECT field, value FROM ln GROUP BY ALL) USING (field, value) GROUP BY field),
top AS (SELECT *, row_number() OVER (ORDER BY common DESC, field) AS r FROM com QUALIFY r <= 12), chosen AS (SELECT field, r FROM top WHERE common >= 5),
combo AS (SELECT a.field AS a, b.field AS b, CASE WHEN a.r = b.r THEN a.field ELSE a.field || '+' || b.field END AS fields FROM chosen a JOIN chosen b ON a.r <= b.r),
vo AS (SELECT fields, x.name, x.value AS v, y.value AS w, count(*) AS n FROM combo JOIN lo x ON x.field = a JOIN lo y ON y.field = b AND y.id = x.id GROUP BY ALL), vn AS (SELECT fields, x.name, x.value AS v, y.value AS w, count(*) AS n FROM combo JOIN ln x ON x.field = a JOIN ln y ON y.field = b AND y.id = x.id GROUP BY ALL),
rep AS (SELECT name FROM so GROUP BY name HAVING count(*) > 1 UNION SELECT name FROM sn GROUP BY name HAVING count(*) > 1)
SELECT fields, count_if(o.n = 1 AND n.n = 1)::BIGINT AS unique_pairs, count_if(NOT (o.n = 1 AND n.n = 1))::BIGINT AS ambiguous, count_if(o.n = 1 AND n.n = 1 AND name IN (SELECT name FROM rep))::BIGINT AS disambiguated FROM vo o JOIN vn n USING (fields, name, v, w) GROUP BY fields"""


@query(_COMPOSITE)
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen fields of suppliers and customers, of which the limit lets twelve in."""
    old, new = _side(read(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey", "s_acctbal"), _side(read(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "c_acctbal")
    return audits.composite_keys(old, new, "name", _WHO)
