"""Scope, eligibility and reasons: every exclusion says why, and concerns whole cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SEPARATORS, ScopeRules
from ..functions.columns import folded


def title_reasons(title: Column, rules: ScopeRules = ScopeRules()) -> Column:
    """Why a title is out of scope, as a sorted array; empty if it isn't."""
    text = folded(title)
    reasons = [F.when(F.contains(text, F.lit(w)), F.lit(f"word:{w}")) for w in rules.words]
    bare = F.regexp_replace(text, r"^[\s\[({]+", "")
    reasons += [F.when(F.startswith(bare, F.lit(p)), F.lit(f"prefix:{p}")) for p in rules.prefixes]
    return F.array_sort(F.array_compact(F.array(*reasons)))


def whole_case_filter(rows: DataFrame, offends: Column, key: str = "case_id") -> DataFrame:
    """Rows of the cases of which no row offends."""
    return rows.join(rows.filter(offends).select(key).distinct(), key, "left_anti")


def kpi_reasons(stays: DataFrame, measured: tuple[str, ...]) -> Column:
    """Why a stay is not in the stage figures; fails closed."""
    tests = {
        "no_status": F.col("status").isNull(),
        "not_measured": ~F.coalesce(F.col("role").isin(*measured), F.lit(False)),
        "open": F.col("ended").isNull(),
        "no_duration": F.coalesce(F.col("ended") - F.col("started") <= 0, F.lit(False)),
    }
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))


def is_pool(reasons: Column, pool: list[str]) -> Column:
    return (F.size(reasons) > 0) & (F.size(F.array_except(reasons, F.array(*map(F.lit, pool)))) == 0)


def talent_reasons(names: Column, other: Column, collectives: tuple[str, ...] = ("group", "various"), squad: str = "squad") -> Column:
    """Why a case's people aren't one person: names is the list of one column, other the text of a second.

    The same name in both columns counts once.  Null and blank names are none.
    """
    names = F.coalesce(F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != ""), F.array().cast("array<string>"))
    other = F.coalesce(F.trim(other), F.lit(""))
    every = F.filter(F.concat(names, F.array(other)), lambda n: n != "")
    same = (F.size(names) == 1) & (folded(F.try_element_at(names, F.lit(1))) == folded(other))
    tests = {
        "both_columns": (F.size(names) > 0) & (other != "") & ~F.coalesce(same, F.lit(False)),
        "none": F.size(every) == 0,
        "several": (F.size(names) > 1) | F.exists(every, lambda n: F.regexp_like(n, F.lit(SEPARATORS))),
        "collective": F.exists(every, lambda n: folded(n).isin(*collectives)),
        "squad": F.exists(every, lambda n: F.regexp_like(folded(n), F.lit(rf"\b{squad}\b"))),
    }
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))


def talent_situation(names: Column, other: Column) -> Column:
    """How sure the one name of a register is: none, both, several, review or single; null names: unregistered."""
    n = F.size(F.filter(names, lambda x: F.trim(x) != ""))
    text = F.coalesce(F.trim(other), F.lit(""))
    return F.when(names.isNull(), "unregistered").when((n == 0) & (text == ""), "none").when((n > 0) & (text != ""), "both").when(n > 1, "several").when(F.regexp_like(F.concat(F.lit(" "), F.regexp_replace(text, "([&/])", " $1 ")), F.lit(SEPARATORS)), "review").otherwise("single")


def cell_state(present: Column, value: Column) -> Column:
    """A cell that wasn't returned is unverified; that differs from a blank one."""
    return F.when(~F.coalesce(present, F.lit(False)), "unverified").when(F.coalesce(F.trim(value), F.lit("")) == "", "blank").otherwise("filled")


def input_reasons(value: Column, verified: Column, measured: tuple[str, ...]) -> Column:
    """Why a case's kind of input is out of scope; a cell that nobody could read is not a blank one."""
    kind = F.nullif(folded(value), F.lit(""))
    tests = {"input_unverified": ~F.coalesce(verified, F.lit(False)), "input_blank": verified & kind.isNull(), "input_other": verified & ~kind.isin(*measured)}
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))


def only_column(columns: DataFrame, title: str) -> str:
    """The id of the one column of columns(id, title) with that title, however it is written; else an error."""
    got = columns.filter(folded(F.col("title")) == folded(F.lit(title))).select("id").limit(2).collect()
    if len(got) != 1:
        raise ValueError(f"{'no' if not got else 'more than one'} column is called {title}")
    return got[0]["id"]


def stage_number(status: Column, stages: tuple[str, ...]) -> Column:
    """Place of a status in the order of stages, from 1; null for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, stages)), status), F.lit(0).cast("long")).cast("int")


def people_fields(cells: DataFrame, people: DataFrame) -> DataFrame:
    """item, role, names, situation of cells(item, role, person_id, text), by people(person_id, name).

    Names of all persons of a role, sorted, joined by ' + '.  Where no id is known, the cell's text counts if
    it names one person only.  situation: known, text, several_texts or none.
    """
    known = cells.join(people, "person_id", "left").groupBy("item", "role").agg(F.array_sort(F.collect_set("name")).alias("_n"), F.max(F.nullif(F.trim("text"), F.lit(""))).alias("_t"))
    one = F.col("_t").isNotNull() & ~F.regexp_like("_t", F.lit(SEPARATORS))
    names = F.when(F.size("_n") > 0, F.array_join("_n", " + ")).when(one, F.col("_t"))
    situation = F.when(F.size("_n") > 0, "known").when(one, "text").when(F.col("_t").isNotNull(), "several_texts").otherwise("none")
    return known.select("item", "role", names.alias("names"), situation.alias("situation"))
