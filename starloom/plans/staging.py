"""Source -> staging: one generic job (``stage_table``) driven by one spec per source table.

Per table: watermark extract (SC1-SC4) -> row hash (V1) -> validation against the *source*
parents (V3-V9) -> valid rows only (V10) -> full refresh (K1) or hash-diff upsert (K2) ->
lineage envelope (SC10). The result is the next version of the staging table plus a
one-row counts frame for the load log.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Iterable
from contextlib import ExitStack
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.operators.keys import ROWS_PER_RANGE, SMALL_MAX_ROWS, KeyRange, assign_keys, key_ranges, max_key
from starloom.operators.loads import hash_upsert, latest_of_extract
from starloom.operators.lookups import bounded_count
from starloom.operators.validation import (
    PARENT_BROADCAST_MAX_ROWS, ForeignKey, Rule, between, custom, greater_than, in_domain, ordered, required,
    typed_together, validate,
)
from starloom.plans import schemas
from starloom.plans.blocks import BlockTable, Counts, HashBlocks
from starloom.sources.lineage import stamp_lineage
from starloom.sources.watermark import created_watermark, date_watermark, inclusive_watermark


@dataclass(frozen=True)
class FK:
    col: str
    parent: str
    parent_col: str = "id"
    when: tuple | None = None    # (column, value): the check holds for rows of that value only (V9)
    needed: bool = False         # a row of that value must have a reference


@dataclass(frozen=True)
class TableSpec:
    name: str
    system: str                            # program_ops | finance_ops
    load: str                              # full | upsert
    watermark: str = "updated"             # updated | created | date:<col> | parents
    required: tuple = ("id",)
    domains: tuple = ()                    # (col, (values...))
    positive: tuple = ()                   # col > 0
    non_negative: tuple = ()               # col >= 0
    at_least: tuple = ()                   # (col, bound)
    ranges: tuple = ()                     # (col, low, high)
    ordered: tuple = ()                    # (first, second)
    fks: tuple = field(default_factory=tuple)
    parents: tuple = ()                    # (fk col, parent table) for the parent watermark
    key: str = "id"                        # business key of the table
    columns: tuple = ()                    # source columns; default: the declared source schema

    def source_columns(self) -> list[str]:
        return list(self.columns) if self.columns else schemas.columns(self.name)

    def rules(self) -> list[Rule]:
        """Rules in the order in which their texts are joined. The texts are fixed formats that readers of rejected rows rely on; they name the
        condition that failed, in two styles: program tables spell out the whole condition, finance tables name the column first."""
        finance = self.system == FIN
        out = []

        def add(rule: Rule, text: str) -> None:
            out.append(Rule(rule.fails, f"{text}; "))

        for c in self.required:
            add(required(c), f"{_named(c)} missing")
            if c in self.positive:
                add(greater_than(c, 0), f"{c} invalid: {c} <= 0")
        for c in self.positive:
            if c not in self.required:
                add(greater_than(c, 0), f"{c} invalid: {c} <= 0")
        for c in self.non_negative:
            add(greater_than(c, 0, inclusive=True), f"{c} invalid: {c} < 0")
        for c, values in self.domains:
            add(in_domain(c, list(values)), f"{c} invalid: {c} NOT IN ({', '.join(values)})")
        for c, bound in self.at_least:
            add(greater_than(c, bound, inclusive=True), f"{c} IS NOT NULL AND {c} < {bound}")
        for c, low, high in self.ranges:
            add(between(c, low, high), f"{c} IS NOT NULL AND ({c} < {low} OR {c} > {high})")
        for a, b in self.ordered:
            if finance:
                text = f"{a} invalid: {b} invalid: {a} > {b}"
            elif a in self.required and b in self.required:
                text = f"{a} > {b}"
            else:
                text = f"{b} IS NOT NULL AND {a} IS NOT NULL AND {a} > {b}"
            add(ordered(a, b), text)
        for fk in self.fks:
            if fk.needed:
                add(custom(self.asked(fk) & F.col(fk.col).isNull(), ""), f"{fk.when[0]} = {fk.when[1]} AND {fk.col} missing")
        return out

    def asked(self, fk: FK) -> Column | None:
        """For which rows a conditional reference is checked."""
        return None if fk.when is None else F.lower(F.trim(fk.when[0])) == fk.when[1]

    def reference_text(self, fk: FK) -> str:
        """What a row says whose reference is in no parent; cut to 150 characters like the texts that readers know."""
        subject = fk.col if fk.when is None else f"{fk.when[0]} = {fk.when[1]} AND {fk.col}"
        text = (f"{subject} invalid reference (SELECT 1 FROM {SOURCE_DATABASE.get(self.system, self.system)}.{self.system}.{fk.parent} p "
                f"WHERE p.{fk.parent_col} = s.{fk.col})")
        return (text if len(text) <= TEXT_LENGTH else text[:TEXT_LENGTH - 3] + "...") + "; "


#: Longest text of one failed rule.
TEXT_LENGTH = 150


def _named(col: str) -> str:
    """Column names that are words of SQL are bracketed in messages."""
    return f"[{col}]" if col == "date" else col


def _spec(name, system, load, **kw) -> TableSpec:
    return TableSpec(name, system, load, **kw)


P, FIN = "program_ops", "finance_ops"

# Per-table validation rules, load strategy and watermark of each source table.
SPECS = [
    _spec("centers", P, "full", required=("id", "name")),
    _spec("domains", P, "full", required=("id", "name")),
    _spec("score_scales", P, "full", required=("id", "name", "min_score", "max_score"),
          ordered=(("min_score", "max_score"),)),
    _spec("closure_reasons", P, "full", required=("id", "title")),
    _spec("absence_reasons", P, "full", required=("id", "title")),
    _spec("no_score_reasons", P, "full", required=("id", "title")),
    _spec("children", P, "upsert", required=("id", "center_id", "first_name", "last_name", "status"),
          fks=(FK("center_id", "centers"),)),
    _spec("teachers", P, "upsert", required=("id", "center_id", "first_name", "last_name", "employment_status"),
          fks=(FK("center_id", "centers"),)),
    _spec("users", P, "upsert", required=("id", "username", "password_hash", "role"),
          fks=(FK("teacher_id", "teachers"),)),
    _spec("task_templates", P, "upsert", required=("id", "domain_id", "title"),
          fks=(FK("domain_id", "domains"), FK("default_score_scale_id", "score_scales"), FK("created_by", "users"))),
    _spec("center_daily_status", P, "upsert", required=("id", "center_id", "date", "status"),
          fks=(FK("center_id", "centers"), FK("closure_reason_id", "closure_reasons"), FK("created_by", "users"))),
    _spec("child_daily_status", P, "upsert", required=("id", "child_id", "date", "status"),
          fks=(FK("child_id", "children"), FK("absence_reason_id", "absence_reasons"), FK("created_by", "users"))),
    _spec("child_task_plans", P, "upsert",
          required=("id", "child_id", "domain_id", "task_title", "score_scale_id", "start_date"),
          ordered=(("start_date", "end_date"),),
          fks=(FK("child_id", "children"), FK("task_template_id", "task_templates"), FK("domain_id", "domains"),
               FK("score_scale_id", "score_scales"), FK("created_by", "users"))),
    _spec("daily_task_assignments", P, "upsert",
          required=("id", "child_id", "date", "domain_id", "task_title", "score_scale_id", "status"),
          fks=(FK("child_id", "children"), FK("child_task_plan_id", "child_task_plans"),
               FK("task_template_id", "task_templates"), FK("domain_id", "domains"),
               FK("score_scale_id", "score_scales"), FK("planned_by", "users"))),
    _spec("assessment_sessions", P, "upsert",
          required=("id", "child_id", "teacher_id", "center_id", "date", "session_status"),
          ordered=(("started_at", "ended_at"),),
          fks=(FK("child_id", "children"), FK("teacher_id", "teachers"), FK("center_id", "centers"))),
    _spec("task_assessments", P, "upsert",
          required=("id", "daily_task_assignment_id", "assessment_session_id", "child_id", "teacher_id", "date",
                    "assessment_status", "attempt_no"),
          at_least=(("attempt_no", 1),), ranges=(("normalized_score", 0, 100),),
          fks=(FK("daily_task_assignment_id", "daily_task_assignments"),
               FK("assessment_session_id", "assessment_sessions"), FK("child_id", "children"),
               FK("teacher_id", "teachers"), FK("no_score_reason_id", "no_score_reasons"))),
    _spec("notes", P, "upsert", required=("id", "note_scope", "note_text"),
          fks=(FK("center_id", "centers"), FK("child_id", "children"), FK("teacher_id", "teachers"),
               FK("daily_task_assignment_id", "daily_task_assignments"),
               FK("task_assessment_id", "task_assessments"), FK("created_by", "users"))),
    _spec("note_batches", P, "upsert", watermark="created", required=("id", "note_scope", "note_text"),
          fks=(FK("created_by", "users"),)),
    _spec("note_batch_items", P, "upsert", watermark="parents", required=("id", "note_batch_id", "note_id"),
          fks=(FK("note_batch_id", "note_batches"), FK("note_id", "notes")),
          parents=(("note_batch_id", "note_batches"), ("note_id", "notes"))),
    _spec("audit_logs", P, "upsert", watermark="created", required=("id", "entity_name", "entity_id", "action"),
          fks=(FK("user_id", "users"),)),
    _spec("donors", FIN, "full", required=("id", "full_name", "donor_type"),
          domains=(("donor_type", ("individual", "organization")),)),
    _spec("campaigns", FIN, "full", required=("id", "title"), non_negative=("target_amount",),
          ordered=(("start_date", "end_date"),)),
    _spec("expense_categories", FIN, "full", required=("id", "name")),
    _spec("donations", FIN, "upsert",
          required=("id", "donor_id", "amount", "currency", "donation_type", "donation_date", "status"),
          positive=("amount",),
          domains=(("donation_type", ("cash", "bank_transfer", "online", "in_kind")),
                   ("status", ("pending", "confirmed", "rejected", "refunded"))),
          fks=(FK("donor_id", "donors"), FK("campaign_id", "campaigns"))),
    _spec("expenses", FIN, "upsert",
          required=("id", "center_id", "category_id", "amount", "currency", "expense_date", "status"),
          positive=("amount",), domains=(("status", ("pending", "approved", "rejected")),),
          fks=(FK("category_id", "expense_categories"),)),
    _spec("payments", FIN, "upsert",
          required=("id", "payment_type", "center_id", "amount", "currency", "payment_date", "status"),
          positive=("amount",),
          domains=(("payment_type", ("salary", "bonus", "vendor", "refund")),
                   ("status", ("pending", "approved", "paid", "cancelled", "rejected")))),
    _spec("budget_allocations", FIN, "upsert", watermark="created",
          required=("id", "source_type", "center_id", "allocated_amount", "allocation_date"),
          positive=("allocated_amount",), domains=(("source_type", ("donation", "internal_budget")),),
          fks=(FK("source_id", "donations", when=("source_type", "donation"), needed=True),
               FK("category_id", "expense_categories"))),
    _spec("financial_transactions", FIN, "upsert", watermark="created",
          required=("id", "entity_type", "entity_id", "transaction_type", "amount", "transaction_date"),
          positive=("amount",),
          domains=(("entity_type", ("donation", "expense", "payment")), ("transaction_type", ("credit", "debit"))),
          fks=(FK("entity_id", "donations", when=("entity_type", "donation")),
               FK("entity_id", "expenses", when=("entity_type", "expense")),
               FK("entity_id", "payments", when=("entity_type", "payment")))),
    _spec("currency_rates", FIN, "upsert", watermark="date:rate_date",
          required=("id", "from_currency", "to_currency", "rate", "rate_date"), positive=("rate",)),
]
SPEC_BY_NAME = {s.name: s for s in SPECS}
SOURCE_DATABASE = {P: "program_ops_source", FIN: "finance_ops_source"}


def _extract(spec: TableSpec, src: DataFrame, sources: dict[str, DataFrame], to_date) -> DataFrame:
    if spec.watermark == "updated":
        return inclusive_watermark(src, to_date)
    if spec.watermark == "created":
        return created_watermark(src, to_date)
    if spec.watermark.startswith("date:"):
        return date_watermark(src, to_date, spec.watermark.split(":", 1)[1])
    out = src
    for fk, parent in spec.parents:   # SC4: both parents must themselves be inside the watermark
        pspec = SPEC_BY_NAME[parent]
        p = _extract(pspec, sources[parent], sources, to_date).select(F.col(pspec.key).alias(f"_p_{fk}"))
        out = out.join(p, F.col(fk) == F.col(f"_p_{fk}"), "left_semi")
    return out


def _updated_at(df: DataFrame) -> Column:
    cols = [c for c in ("updated_at", "created_at") if c in df.columns]
    return F.coalesce(*[F.col(c) for c in cols]) if cols else F.lit(None).cast("timestamp_ntz")


ENVELOPE = ["etl_batch_id", "source_system", "source_database", "source_schema", "source_table",
            "extracted_at", "source_updated_at", "row_hash", "is_valid", "validation_message"]


def checked_extract(spec: TableSpec, sources: dict[str, DataFrame], to_date: _dt.datetime, batch_id: int,
                    extracted_at: _dt.datetime | None = None, counted: Observation | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Returns (extract with its verdicts, its valid rows in their lineage envelope); ``counted`` gets rows_read and rows_valid from
    the job that materialises the extract."""
    src = sources[spec.name]
    cols = spec.source_columns()
    x = _extract(spec, src.select(*cols), sources, to_date)
    fks = [ForeignKey(fk.col, sources[fk.parent], fk.parent_col, spec.reference_text(fk), spec.asked(fk), fk.when) for fk in spec.fks]
    # The validated extract is the work table every later step reads (valid rows, rejects,
    # counts): materialise it once rather than re-running the referential joins per reader.
    from starloom.session import cut_in_parts, discard, holding, stored_parts
    by_key = True
    if counted is not None:
        checked = validate(x, spec.rules(), fks)
        parts = [checked.observe(counted, F.count(F.lit(1)).alias("rows_read"), F.count(F.when(F.col("is_valid"), 1)).alias("rows_valid"))]
    else:
        by_key, ranged = _ranged(spec, src, x, fks)

        def written():
            for rows, met in ranged:
                part = validate(rows, spec.rules(), met)
                yield part
                discard(part)       # the ids of its typed references' parents
        parts = written()
    stored = cut_in_parts(parts)
    # A hash does not compress and follows from the columns: it is made when it is asked for.
    checked = holding(stored.select(*cols, row_hash(*cols).alias("row_hash"), "is_valid", "validation_message"), stored)
    checked._by_key = stored_parts(stored) if by_key else [stored]
    valid = checked.filter(F.col("is_valid")).drop("validation_message")
    return checked, _stamped(spec, valid, to_date, batch_id, extracted_at)


def _ranged(spec: TableSpec, src: DataFrame, x: DataFrame, fks: list[ForeignKey]) -> tuple[bool, list[tuple[DataFrame, list[ForeignKey]]]]:
    """(whether they are ranges of the key, the rows to be checked at a time with their references). Rows that meet a large parent are
    shuffled, and a large table lies on the disk twice while it is numbered: it goes range by range. Typed references meet all their
    parents at once, so their rows and the parents' ids go by ranges of the reference."""
    def large(fk: ForeignKey) -> bool:
        return bounded_count(fk.parent, PARENT_BROADCAST_MAX_ROWS) > PARENT_BROADCAST_MAX_ROWS
    typed = typed_together(fks)
    if len(typed) == 1:
        (_, col), = typed
        places = {i for at in typed.values() for i in at}
        met = [fks[i] for i in places]
        whole = all(df.schema[c].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
                    for df, c in [(x, col), *((fk.parent, fk.parent_col) for fk in met)])
        ranges = key_ranges(x, col, x.count()) if whole and any(large(fk) for fk in met) else [KeyRange()]
        if len(ranges) > 1:
            low, high = x.agg(F.min(col), F.max(col)).first()

            def within(r: KeyRange, fk: ForeignKey) -> ForeignKey:
                # No row refers to a parent below the least reference or above the greatest.
                asked = F.col(fk.parent_col).between(F.lit(low), F.lit(high))
                return replace(fk, parent=r.of(fk.parent.filter(asked), fk.parent_col))
            return False, [(r.of(x, col), [within(r, fk) if i in places else fk for i, fk in enumerate(fks)]) for r in ranges]
    apart = {i for at in typed.values() for i in at}
    if bounded_count(src, ONE_AT_A_TIME_ROWS) > ONE_AT_A_TIME_ROWS or any(i not in apart and large(fk) for i, fk in enumerate(fks)):
        ranges = key_ranges(x, spec.key, x.count())
        met = _met(x, spec.key, ranges, fks, [i for i, fk in enumerate(fks) if i not in apart and large(fk)])
        return True, [(r.of(x, spec.key), mine) for r, mine in zip(ranges, met, strict=True)]
    return True, [(x, fks)]


def _met(x: DataFrame, key: str, ranges: list[KeyRange], fks: list[ForeignKey], places: list[int]) -> list[list[ForeignKey]]:
    """For each range of ``x`` its references, those at ``places`` with the part of their parent that its rows can meet: none refers to a
    parent below the least reference of its range or above the greatest. So a parent is read about once, not once for each range, where
    references rise with the key."""
    whole = ("tinyint", "smallint", "int", "bigint")
    places = [i for i in places if all(df.schema[c].dataType.simpleString() in whole
                                       for df, c in ((x, fks[i].col), (fks[i].parent, fks[i].parent_col)))]
    if len(ranges) == 1 or not places:
        return [fks] * len(ranges)
    at = F.lit(None).cast("int")
    for n, r in reversed(list(enumerate(ranges))):
        at = F.when(r.holds(F.col(key)), n).otherwise(at)
    asked = {i: F.col(fks[i].col) if fks[i].when is None else F.when(fks[i].when, F.col(fks[i].col)) for i in places}
    ends = x.groupBy(at.alias("at")).agg(*[f(asked[i]).alias(f"{end}{i}") for i in places for end, f in (("low", F.min), ("high", F.max))])
    ends = {row["at"]: row for row in ends.collect()}      # one row for each range
    out = []
    for n in range(len(ranges)):
        mine = list(fks)
        for i in places:
            low, high = (ends[n][f"{end}{i}"] if n in ends else None for end in ("low", "high"))
            mine[i] = replace(fks[i], parent=fks[i].parent.filter(
                F.lit(False) if low is None else F.col(fks[i].parent_col).between(F.lit(low), F.lit(high))))
        out.append(mine)
    return out


def _stamped(spec: TableSpec, valid: DataFrame, to_date, batch_id: int, extracted_at: _dt.datetime | None) -> DataFrame:
    """Valid rows with their lineage envelope."""
    staged = stamp_lineage(valid, batch_id, spec.system.upper(), SOURCE_DATABASE.get(spec.system, spec.system),
                           spec.system,
                           spec.name, extracted_at or to_date, _updated_at(valid))
    staged = staged.withColumns({"is_valid": F.lit(True), "validation_message": F.lit(None).cast("string")})
    ids = ["stg_row_id"] if "stg_row_id" in valid.columns else []
    return staged.select(*ids, *spec.source_columns(), *ENVELOPE)


#: Larger tables of a staging run are shuffled one after the other, each by all tasks, so that the disk holds the shuffles of one of them.
ONE_AT_A_TIME_ROWS = ROWS_PER_RANGE

COUNTS_SCHEMA = "rows_read long, rows_valid long, rows_rejected long, rows_inserted long, rows_updated long"


def stage_into(spec: TableSpec, sources: dict[str, DataFrame], table: BlockTable, to_date: _dt.datetime, batch_id: int,
               extracted_at: _dt.datetime | None = None, tag: int | None = None) -> tuple[Counts, DataFrame, DataFrame]:
    """The staging job over a table in blocks: an upsert (K2) that reads and writes the blocks which the extract changes. Returns (what the
    load did, one-row counts, rejected rows). Counts come from the jobs that materialise the extract and write the table. Tables that
    ``stage_table`` refreshes in full are upserted, too: a deletion in the source does not reach them here."""
    counted = Observation()
    checked, staged = checked_extract(spec, sources, to_date, batch_id, extracted_at, counted)
    done = table.upsert(staged, ("source_updated_at",), tag)
    read, valid = counted.get["rows_read"], counted.get["rows_valid"]
    counts = checked.sparkSession.createDataFrame([(read, valid, read - valid, done.rows_inserted, done.rows_updated)], COUNTS_SCHEMA)
    return done, counts, checked.filter(~F.col("is_valid"))


def staging_blocks(spark: SparkSession, spec: TableSpec, root: str, layout=HashBlocks()) -> BlockTable:
    return BlockTable(spark, root, (spec.key,), layout, row_id="stg_row_id", valid_col="is_valid")


def stage_table(spec: TableSpec, sources: dict[str, DataFrame], current: DataFrame | None,
                to_date: _dt.datetime, batch_id: int, extracted_at: _dt.datetime | None = None
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (next staging version, one-row counts, rejected rows)."""
    placed, others, counts, checked, _ = _stage(spec, sources, current, to_date, batch_id, extracted_at)
    return _together(placed, others), counts, checked.filter(~F.col("is_valid"))


def _together(placed: DataFrame | None, others: DataFrame | None) -> DataFrame:
    parts = [df for df in (others, placed) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _stage(spec: TableSpec, sources: dict[str, DataFrame], current: DataFrame | None, to_date: _dt.datetime, batch_id: int,
           extracted_at: _dt.datetime | None = None, before_moving=lambda rows: None, keep_checked: bool = True
           ) -> tuple[DataFrame | None, DataFrame | None, DataFrame, DataFrame, list[DataFrame]]:
    """(the rows of the next staging version that are written with their places already, its other rows, one-row counts, the extract with
    its verdicts, and the work tables that nothing reads once the next version is written). ``before_moving`` is told how many rows the
    source has, counted up to one above ONE_AT_A_TIME_ROWS, before the first of them is written. Without ``keep_checked`` the extract of a
    first load goes range by range as it is numbered."""
    from starloom.session import cut_lineage, discard, holding, shuffles_removed
    cols, key, envelope = spec.source_columns(), spec.key, ENVELOPE
    before_moving(bounded_count(sources[spec.name], ONE_AT_A_TIME_ROWS))
    checked, staged = checked_extract(spec, sources, to_date, batch_id, extracted_at)
    spent = [checked]

    # One pass over the materialised extract gives the read/valid/rejected counts, and whether ids repeat.
    # An id lies in one range.
    rows_read = rows_valid = staged_rows = 0
    for part in checked._by_key:
        with shuffles_removed(checked.sparkSession):
            read = part.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_valid").cast("long")).alias("v"),
                            F.countDistinct(F.when(F.col("is_valid"), F.col(key))).alias("ids")).first()
        rows_read, rows_valid, staged_rows = rows_read + int(read["n"]), rows_valid + int(read["v"] or 0), staged_rows + int(read["ids"])
    apart = checked._by_key
    if staged_rows < rows_valid:
        apart = []
        # Repeated ids (several extract files for one id): the latest row stands for the id.
        staged = cut_lineage(latest_of_extract(staged, [key], ["source_updated_at"]))
        spent.append(staged)

    def numbered(rows: DataFrame, n: int, base: int, parts=()) -> DataFrame:
        # The envelope holds the same in every row or follows from the source columns, as the hash does, so rows are ordered without it.
        bare = assign_keys(rows.select(*cols), [key], "stg_row_id", base=base, known_rows=n, stored=True,
                           parts=[p.filter("is_valid").select(*cols) for p in parts],
                           written=lambda i: None if keep_checked or not parts else discard(parts[i]))
        return holding(_stamped(spec, bare.withColumn("row_hash", row_hash(*cols)), to_date, batch_id, extracted_at), bare)
    written = None      # rows of the next version that lie in work tables already
    if spec.load == "full" or current is None:
        inserted, updated, have = staged_rows, 0, None
        fresh_rows, fresh = staged_rows, numbered(staged, staged_rows, 0, apart if len(apart) > 1 else ())
    else:
        now = staged.withColumn("stg_row_id", F.lit(None).cast("long")).select("stg_row_id", *cols, *envelope)

        def merged_rows():      # by ranges of the key, so that the disk holds the shuffles of one
            for r in key_ranges(staged, key, staged_rows):
                rows = hash_upsert(r.of(current.select("stg_row_id", *cols, *envelope), key), r.of(now, key),
                                   [key], keep_old=("stg_row_id",), unique=True)
                yield rows
                discard(rows)       # its matches; the range is written
        a, top = F.col("upsert_action"), max_key(current, "stg_row_id")
        if current.filter(F.col("stg_row_id").isNull()).isEmpty():
            # The rows that keep their places are written as they stay, those that get one apart from them.
            kept, added = [], []
            for rows in merged_rows():
                kept.append(_cut_staged([rows.filter(a != "insert")], cols))
                added.append(_cut_staged([rows.filter(a == "insert")], cols))
            old, new = (holding(reduce(DataFrame.unionByName, parts), *parts) for parts in (kept, added))
            spent.append(new)
            inserted, updated = new.count(), old.filter(a == "update").count()
            have = holding(old.select("stg_row_id", *cols, *envelope), old)
            fresh_rows, fresh = inserted, numbered(new, inserted, top)
            if fresh_rows > SMALL_MAX_ROWS or bounded_count(old, SMALL_MAX_ROWS) > SMALL_MAX_ROWS:
                written = have
            else:       # few rows get one work table
                spent.append(old)
        else:       # old rows that never had a number keep their envelope
            merged = _cut_staged(merged_rows(), cols)
            spent.append(merged)
            acts = merged.agg(F.sum((a == "insert").cast("long")).alias("i"),
                              F.sum((a == "update").cast("long")).alias("u")).first()
            inserted, updated = int(acts["i"] or 0), int(acts["u"] or 0)
            have = merged.filter(F.col("stg_row_id").isNotNull()).select("stg_row_id", *cols, *envelope)
            new = merged.filter(F.col("stg_row_id").isNull())
            if new.filter(a != "insert").isEmpty():
                fresh_rows, fresh = inserted, numbered(new, inserted, top)
            else:
                fresh_rows = new.count()
                fresh = assign_keys(new.drop("stg_row_id", "upsert_action"), [key], "stg_row_id", base=top, known_rows=fresh_rows, stored=True)
    fresh = holding(fresh.select("stg_row_id", *cols, *envelope), fresh)
    counts = checked.sparkSession.createDataFrame(
        [(rows_read, rows_valid, rows_read - rows_valid, inserted, updated)], COUNTS_SCHEMA)
    if written is not None:
        if fresh_rows <= SMALL_MAX_ROWS:
            return written, fresh, counts, checked, spent
        return holding(_together(fresh, written), fresh, written), None, counts, checked, spent
    if fresh_rows <= SMALL_MAX_ROWS:
        return None, _together(fresh, have), counts, checked, spent
    return fresh, have, counts, checked, spent


def _cut_staged(parts: Iterable[DataFrame], cols: list[str]) -> DataFrame:
    """``cut_in_parts`` of staged rows: a hash is stored where it is not that of the row's columns, and else made when it is asked for."""
    from starloom.session import cut_in_parts, holding
    made = row_hash(*cols)
    odd = F.when(~F.col("row_hash").eqNullSafe(made), F.struct("row_hash"))
    columns = []

    def bare():
        for rows in parts:
            columns[:] = rows.columns
            yield rows.withColumn("_odd_hash", odd).drop("row_hash")
    stored = cut_in_parts(bare())
    out = stored.withColumn("row_hash", F.when(F.col("_odd_hash").isNotNull(), F.col("_odd_hash.row_hash")).otherwise(made)).select(*columns)
    return holding(out, stored)


def run_staging(spark: SparkSession, system: str, sources: dict[str, DataFrame],
                staging: dict[str, DataFrame], to_date: _dt.datetime, batch_id: int = 1,
                checkpoint: bool = True, specs: tuple[str, ...] | None = None, workers: int = 4
                ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stage every table of one system (or the named ``specs``); returns (new staging, load log)."""
    from starloom.session import discard, holding, run_concurrently
    if to_date is None:
        raise ValueError("to_date is required")
    chosen = [s for s in SPECS if s.system == system and (specs is None or s.name in specs)]
    turn = threading.Lock()

    def one(spec):
        # Validation reads the source parents, never staging, so tables stage independently.
        def build():
            with ExitStack() as held:
                def before_moving(rows: int) -> None:
                    if rows > ONE_AT_A_TIME_ROWS:
                        held.enter_context(turn)
                placed, others, counts, _, spent = _stage(spec, sources, staging.get(spec.name), to_date, batch_id, before_moving=before_moving,
                                                           keep_checked=not checkpoint)
                if checkpoint:
                    if others is not None:
                        others = _cut_staged([others], spec.source_columns())
                    for work in spent:     # read by nothing from here on
                        discard(work)
                return holding(_together(placed, others), placed, others), counts
        return build

    done = run_concurrently({spec.name: one(spec) for spec in chosen}, workers=workers)
    out, log_rows = {}, None
    for i, spec in enumerate(chosen, start=1):
        out[spec.name], counts = done[spec.name]
        row = counts.select(F.lit(i).cast("long").alias("load_log_id"), F.lit(batch_id).alias("etl_batch_id"),
                            F.lit(spec.name).alias("source_table"), "*")
        log_rows = row if log_rows is None else log_rows.unionByName(row)
    return out, log_rows
