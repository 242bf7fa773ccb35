"""Board metadata and items: finding columns, decoding typed cells, the catalogue of columns over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import folded

CELL = "array<struct<id:string,value:string>>"
PEOPLE = "struct<personsAndTeams:array<struct<id:string,kind:string>>>"


def discover(columns: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """field, how, n, column_id of columns(id, title): which column plays each field's part.

    A title that equals an alias beats one that begins with it.  column_id is null where several fit.
    """
    title = folded(F.col("title"))
    cases = [F.struct(F.lit(f).alias("field"), F.when(title.isin(*names), 0).when(F.array_contains(F.transform(F.array(*map(F.lit, names)), lambda a: F.startswith(title, a)), True), 1).alias("rank")) for f, names in aliases.items()]
    fits = columns.select("id", F.explode(F.array(*cases)).alias("x")).select("id", "x.*").filter("rank is not null")
    by_rank = fits.groupBy("field", "rank").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    best = by_rank.groupBy("field").agg(F.min_by(F.struct("rank", "n", "id"), "rank").alias("b"))
    how = F.when(F.col("b.rank") == 0, "title").otherwise("prefix")
    return best.select("field", how.alias("how"), F.col("b.n").alias("n"), F.when(F.col("b.n") == 1, F.col("b.id")).alias("column_id"))


def people_names(raw: Column, names: Column) -> Column:
    """Names of the persons of a people cell, sorted and joined by ' + '; names is a map id -> name."""
    entries = F.filter(F.from_json(raw, PEOPLE)["personsAndTeams"], lambda p: p["kind"] == "person")
    return F.nullif(F.array_join(F.array_sort(F.array_compact(F.transform(entries, lambda p: F.try_element_at(names, p["id"])))), " + "), F.lit(""))


def _looked_up(keys: Column, table: Column) -> Column:
    return F.transform(keys, lambda k: F.try_element_at(table, k))


def decode(items: DataFrame, spec: dict[str, tuple[str, str]], labels: dict[str, dict[str, str]]) -> DataFrame:
    """items(item_id, cells) with one column for each field of spec, {field: (column id, kind)}.

    cells is an array of id and JSON value.  Kinds: status (index to label), dropdown (ids to labels, joined
    by ' + '), people (sorted kind:id), text.  labels are those of the board's settings, of the size of a
    board's schema.  An unset or missing cell is null; a set one that can't be read is named in `unread`.
    """
    by_id = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["id"], c["value"])))
    rows = items.select("item_id", by_id.alias("_cells"))
    raw, parsed, made, unread = [], [], [], []
    for field, (column, kind) in spec.items():
        value, known = F.col(f"_raw_{field}"), labels.get(column, {})
        raw.append(F.nullif(F.try_element_at(F.col("_cells"), F.lit(column)), F.lit("null")).alias(f"_raw_{field}"))
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.lit(None).cast("map<string,string>")
        got = F.col(f"_in_{field}")
        if kind == "status":
            parsed.append(F.get_json_object(value, "$.index").alias(f"_in_{field}"))
            cell = F.try_element_at(table, got)
        elif kind == "dropdown":
            parsed.append(_looked_up(F.from_json(value, "ids array<string>")["ids"], table).alias(f"_in_{field}"))
            cell = F.when(~F.exists(got, lambda x: x.isNull()), F.array_join(got, " + "))
        elif kind == "people":
            parsed.append(F.from_json(value, PEOPLE)["personsAndTeams"].alias(f"_in_{field}"))
            cell = F.array_join(F.array_sort(F.transform(got, lambda p: F.concat_ws(":", p["kind"], p["id"]))), " + ")
        elif kind == "text":
            parsed.append(F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v string")["v"].alias(f"_in_{field}"))
            cell = got
        else:
            raise ValueError(f"unknown kind {kind}")
        made.append(cell.alias(field))
        unread.append(F.when(F.col(f"_set_{field}") & F.col(field).isNull(), F.lit(field)))
        parsed.append((parsed[-1] if kind == "status" else value).isNotNull().alias(f"_set_{field}"))
    # One projection after another, so that each cell is parsed once and not again for every use of it.
    rows = rows.select("item_id", *raw).select("item_id", *parsed).select("item_id", *made, *[f"_set_{f}" for f in spec])
    return rows.select("item_id", *spec, F.array_join(F.array_compact(F.array(*unread)), ",").alias("unread"))


def catalogue(previous: DataFrame, current: DataFrame, at: int) -> DataFrame:
    """The catalogue of columns(id, title) at an instant: previous(id, title, first_seen, last_seen) carried on.

    A column that is gone keeps its last title and instant, and is_present is false.
    """
    now = current.select("id", F.col("title").alias("_title"), F.lit(True).alias("_here"))
    both = previous.join(now, "id", "full_outer")
    here = F.coalesce("_here", F.lit(False))
    return both.select("id", F.coalesce("_title", "title").alias("title"), F.coalesce("first_seen", F.lit(at)).alias("first_seen"), F.when(here, F.lit(at)).otherwise(F.col("last_seen")).alias("last_seen"), here.alias("is_present"))


# --- cells whose form differs, under each board's own settings ------------------------------------


def board_columns(boards: DataFrame) -> DataFrame:
    """board_id, column_id, title, kind, labels of boards(board_id, columns): labels are those of the column's settings, as a map."""
    each = boards.select("board_id", F.explode("columns").alias("c"))
    labels = F.from_json(F.col("c.settings_str"), "labels map<string,string>")["labels"]
    return each.select("board_id", F.col("c.id").alias("column_id"), F.col("c.title").alias("title"), F.col("c.type").alias("kind"), labels.alias("labels"))


def status_cell(value: Column, labels: Column) -> Column:
    """index and label of a status cell of any of its forms: {index}, {label: {index, text}}, {label: text}, as number or text.

    The label is that of the cell itself where it has one, else what the board calls the index.
    """
    v = F.try_parse_json(value)
    got = lambda path: F.try_variant_get(v, path, "string")
    nested = F.coalesce(got("$.label.index"), got("$.label.text")).isNotNull()
    index = F.coalesce(got("$.label.index"), got("$.index"))
    plain = F.when(~nested & ~F.startswith(F.ltrim(got("$.label")), F.lit("{")), got("$.label"))
    return F.struct(index.alias("index"), F.coalesce(got("$.label.text"), plain, F.try_element_at(labels, index)).alias("label"))


def decode_boards(items: DataFrame, boards: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """items(board_id, item_id, cells) with a column for each field of spec {field: (column id, kind)}, read under the item's own board.

    Kinds: status, dropdown, people, text.  Labels come from the settings of the board that the item is on, so one index
    may mean one thing here and another there.  A field whose column the board hasn't, or has as another
    kind, is null for all of its items; schema_issues tells these.  unread names set cells that can't be read.
    """
    own = board_columns(boards)
    known = own.groupBy("board_id").agg(F.map_from_entries(F.collect_list(F.struct("column_id", F.struct("kind", "labels")))).alias("_board"))
    cells = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["id"], c["value"])))
    rows = items.select("board_id", "item_id", cells.alias("_cells")).join(known, "board_id", "left")
    parsed, made, unread = [], [], []
    for field, (column, kind) in spec.items():
        meant = F.try_element_at("_board", F.lit(column))
        raw = F.nullif(F.try_element_at("_cells", F.lit(column)), F.lit("null"))
        value, labels = F.when(meant["kind"] == kind, raw), meant["labels"]
        v = F.try_parse_json(value)
        if kind == "status":
            cell = status_cell(value, labels)["label"]
        elif kind == "dropdown":
            ids = F.coalesce(F.try_variant_get(v, "$.ids", "array<string>"), F.array_compact(F.array(F.try_variant_get(v, "$.ids", "string"))))
            names = _looked_up(ids, labels)
            cell = F.when((F.size(names) > 0) & ~F.exists(names, lambda x: x.isNull()), F.array_join(names, " + "))
        elif kind == "people":
            people = F.try_variant_get(v, "$.personsAndTeams", "array<struct<id:string,kind:string>>")
            cell = F.array_join(F.array_sort(F.transform(people, lambda p: F.concat_ws(":", p["kind"], p["id"]))), " + ")
        elif kind == "text":
            cell = F.coalesce(F.try_variant_get(v, "$.text", "string"), F.try_variant_get(v, "$", "string"))
        else:
            raise ValueError(f"unknown kind {kind}")
        empty = F.coalesce(F.try_variant_get(v, "$.ids", "string") == "[]", F.lit(False)) if kind == "dropdown" else F.lit(False)
        parsed += [cell.alias(field), (value.isNotNull() & ~empty).alias(f"_set_{field}")]
        made.append(F.col(field))
        unread.append(F.when(F.col(f"_set_{field}") & F.col(field).isNull(), F.lit(field)))
    rows = rows.select("board_id", "item_id", *parsed)
    return rows.select("board_id", "item_id", *made, F.array_join(F.array_compact(F.array(*unread)), ",").alias("unread"))


def schema_issues(boards: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """board_id, field, issue: fields of spec whose column a board hasn't (no_column) or has as another kind (other_kind)."""
    wanted = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(c).alias("column_id"), F.lit(k).alias("want")) for f, (c, k) in spec.items()]))
    asked = boards.select("board_id", wanted.alias("x")).select("board_id", "x.*")
    rows = asked.join(board_columns(boards).select("board_id", "column_id", "kind"), ["board_id", "column_id"], "left")
    issue = F.when(F.col("kind").isNull(), "no_column").when(F.col("kind") != F.col("want"), "other_kind")
    return rows.select("board_id", "field", issue.alias("issue")).filter("issue is not null")


def unused_labels(items: DataFrame, boards: DataFrame, column: str) -> DataFrame:
    """board_id, index, label: labels that a board's column is set up with and no item of the board has."""
    own = board_columns(boards).filter(F.col("column_id") == column)
    set_up = own.select("board_id", F.explode("labels").alias("index", "label"))
    cell = F.element_at(F.filter("cells", lambda c: c["id"] == column)["value"], 1)
    raw = items.select("board_id", F.when(F.size(F.filter("cells", lambda c: c["id"] == column)) > 0, cell).alias("value"))
    seen = raw.join(own.select("board_id", "labels"), "board_id").select("board_id", status_cell(F.col("value"), F.col("labels")).alias("s")).select("board_id", F.col("s.label").alias("label")).filter("label is not null").distinct()
    return set_up.join(seen, ["board_id", "label"], "left_anti").select("board_id", "index", "label")
