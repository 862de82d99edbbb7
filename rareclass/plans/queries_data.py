"""Registered queries: contract, audit, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareclass.config import COMPONENTS, FEATURES, NON_NEGATIVE, ROW_ID, TARGET
from rareclass.operators import audit, contract, split
from rareclass.plans.catalog import query, rounded
from rareclass.plans.fixture import NULL_PERIOD, raw_transactions, table, text_transactions, transactions
from rareclass.plans.oracle import FOLDED, RANKED, hash_sql, rnd, sql, text_missing, text_number, union
from rareclass.session import materialize, shared_dir
from rareclass.sources.transactions import malformed_rows

COLUMNS = [*FEATURES, TARGET]
LINE_KEY = ["l_quantity", "l_discount", "l_tax"]


# --- contract -----------------------------------------------------------------------------

def _violation_sql(rows: str = "texts", **kw) -> str:
    """Every broken rule, from the texts or from what ``extra`` makes of them."""
    cells = []
    for c in COLUMNS:
        x = text_number(c)
        tests = [("not_numeric", f"NOT {text_missing(c)} AND {x} IS NULL")]
        if c == TARGET:
            tests += [("label_missing", f"{x} IS NULL"), ("label_value", f"{x} NOT IN (0, 1)")]
        else:
            tests += [("infinite", f"ABS({x}) = 'inf'::DOUBLE")]
        if c in NON_NEGATIVE:
            tests += [("negative", f"{x} < 0")]
        cells += [f"SELECT '{t}' AS \"check\", '{c}' AS column_name, COUNT(*) FILTER ({cond}) AS rows FROM {rows}"
                  for t, cond in tests]
        if c != TARGET:
            cells.append(f"SELECT 'entirely_missing', '{c}', CASE WHEN COUNT({x}) = 0 THEN COUNT(*) ELSE 0 END FROM {rows}")
    for v in (0, 1):
        n = f"COUNT(*) FILTER ({text_number(TARGET)} = {v})"
        cells.append(f"SELECT 'few_rows', '{TARGET}={v}', CASE WHEN {n} < 30 THEN 30 - {n} ELSE 0 END FROM {rows}")
    return sql(f"SELECT * FROM ({union(cells)}) WHERE rows > 0", "texts", **kw)


@query("contract_violations", _violation_sql())
def contract_violations(spark, d):
    return contract.training_violations(text_transactions(spark, d))


# Rules that the test view does not break: a feature without a value, a class of few rows.
@query("contract_violations_of_a_spoilt_table", _violation_sql("spoilt", extra=[(
    "spoilt", f"SELECT * REPLACE ('' AS V5, CASE WHEN row_id < 12 THEN '1' ELSE '0' END AS {TARGET}) FROM texts")]))
def contract_violations_of_a_spoilt_table(spark, d):
    spoilt = text_transactions(spark, d).withColumns({
        "V5": F.lit(""), TARGET: F.when(F.col(ROW_ID) < 12, "1").otherwise("0")})
    return contract.training_violations(spoilt)


def _scoring_sql() -> str:
    cells = []
    for c in FEATURES:
        x = text_number(c)
        neg = f"COUNT(*) FILTER ({x} < 0)" if c in NON_NEGATIVE else "0"
        cells.append(f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (NOT {text_missing(c)} AND {x} IS NULL) AS not_numeric,
 COUNT(*) FILTER ({x} IS NULL OR ABS({x}) = 'inf'::DOUBLE) AS not_finite, CAST({neg} AS BIGINT) AS negative FROM texts""")
    return sql(f"SELECT * FROM ({union(cells)}) WHERE not_numeric > 0 OR not_finite > 0 OR negative > 0", "texts")


@query("scoring_violations", _scoring_sql())
def scoring_violations(spark, d):
    return contract.scoring_violations(text_transactions(spark, d))


def _reason_sql() -> str:
    parts = []
    for c in FEATURES:
        x = text_number(c)
        neg = f" WHEN {x} < 0 THEN '{c}:negative'" if c in NON_NEGATIVE else ""
        parts.append(f"""CASE WHEN NOT {text_missing(c)} AND {x} IS NULL THEN '{c}:not_numeric'
 WHEN {x} IS NULL THEN '{c}:missing' WHEN ABS({x}) = 'inf'::DOUBLE THEN '{c}:infinite'{neg} END""")
    return f"concat_ws(',', {', '.join(parts)})"


@query("quarantine_rows", sql(f"SELECT row_id, reasons FROM (SELECT row_id, {_reason_sql()} AS reasons FROM texts) WHERE reasons <> ''", "texts"))
def quarantine_rows(spark, d):
    return contract.quarantine(text_transactions(spark, d))[1].select(ROW_ID, "reasons")


@query("valid_rows", sql(f"SELECT row_id, CAST(Amount AS DOUBLE) AS Amount FROM (SELECT row_id, Amount, {_reason_sql()} AS reasons FROM texts) WHERE reasons = ''", "texts"))
def valid_rows(spark, d):
    valid = contract.quarantine(text_transactions(spark, d))[0]
    return valid.select(ROW_ID, contract.number(valid, "Amount").alias("Amount"))


@query("typed_projection", sql(
    "SELECT row_id, " + ", ".join(rnd(text_number(c), c) for c in FEATURES)
    + f", CAST({text_number(TARGET)} AS INTEGER) AS Class FROM texts", "texts"))
def typed_projection(spark, d):
    typed = contract.project(text_transactions(spark, d), [ROW_ID])
    return rounded(typed.withColumn(TARGET, F.col(TARGET).cast("int")))


# --- duplicates and conflicts -------------------------------------------------------------

@query("dedup_rows", sql(f"""SELECT row_id, Time, V1, V5, Amount, Class FROM
 (SELECT MIN(row_id) AS row_id, {', '.join(COLUMNS)} FROM raw GROUP BY {', '.join(COLUMNS)})""", "raw"))
def dedup_rows(spark, d):
    return audit.distinct_rows(raw_transactions(spark, d), COLUMNS).select(ROW_ID, "Time", "V1", "V5", "Amount", TARGET)


@query("duplicate_count", sql(
    f"SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (SELECT COUNT(*) AS n FROM raw GROUP BY {', '.join(COLUMNS)})", "raw"))
def duplicate_count(spark, d):
    return audit.duplicate_count(raw_transactions(spark, d), COLUMNS)


@query("lineitem_duplicates", f"SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY {', '.join(LINE_KEY)}, l_returnflag)")
def lineitem_duplicates(spark, d):
    return audit.duplicate_count(table(spark, d, "lineitem"), [*LINE_KEY, "l_returnflag"])


@query("label_conflicts", sql(
    f"SELECT {', '.join(COMPONENTS)}, MIN(Class) AS min_label, MAX(Class) AS max_label FROM tx GROUP BY {', '.join(COMPONENTS)} HAVING MIN(Class) <> MAX(Class)", "tx"))
def label_conflicts(spark, d):
    return audit.label_conflicts(transactions(spark, d), COMPONENTS)


@query("lineitem_conflicts", f"SELECT {', '.join(LINE_KEY)}, MIN(l_returnflag) AS min_label, MAX(l_returnflag) AS max_label FROM lineitem GROUP BY {', '.join(LINE_KEY)} HAVING MIN(l_returnflag) <> MAX(l_returnflag)")
def lineitem_conflicts(spark, d):
    return audit.label_conflicts(table(spark, d, "lineitem"), LINE_KEY, "l_returnflag")


# --- audit --------------------------------------------------------------------------------

@query("audit_row", sql(f"""SELECT CAST(SUM(c) AS BIGINT) AS raw_rows, CAST(SUM(c * Class) AS BIGINT) AS raw_frauds,
 {rnd("SUM(c * Class)::DOUBLE / SUM(c)", "raw_fraud_rate", 8)}, CAST(SUM(c - 1) AS BIGINT) AS duplicates_removed,
 COUNT(*) AS clean_rows, CAST(SUM(Class) AS BIGINT) AS clean_frauds, {rnd("SUM(Class)::DOUBLE / COUNT(*)", "clean_fraud_rate", 8)}
 FROM (SELECT Class, COUNT(*) AS c FROM raw GROUP BY {', '.join(COLUMNS)})""", "raw"))
def audit_row(spark, d):
    return rounded(audit.audit_row(raw_transactions(spark, d), COLUMNS), 8)


@query("missing_by_column", sql(union(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS missing FROM raw" for c in COLUMNS), "raw"))
def missing_by_column(spark, d):
    return audit.missing_by_column(raw_transactions(spark, d), COLUMNS)


@query("class_distribution", sql(
    f"SELECT Class, COUNT(*) AS rows, {rnd('100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER ()', 'percent')} FROM tx GROUP BY Class", "tx"))
def class_distribution(spark, d):
    return rounded(audit.class_distribution(transactions(spark, d)))


_DIGEST = "bit_xor(CAST('0x' || substr(md5(concat_ws('|', CAST(row_id AS VARCHAR), CAST(Class AS VARCHAR))), 1, 15) AS BIGINT))"


@query("fingerprint", sql(f"SELECT COUNT(*) AS rows, {_DIGEST} AS digest FROM tx", "tx"))
def fingerprint(spark, d):
    return audit.fingerprint(transactions(spark, d), [ROW_ID, TARGET], portable=True)


@query("merged_fingerprint", """SELECT COUNT(*) AS rows, bit_xor(CAST('0x' || substr(md5(concat_ws('|',
 CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 15) AS BIGINT)) AS digest FROM lineitem""")
def merged_fingerprint(spark, d):
    """The digest of a table from those of its files; a second look reads none of them again."""
    columns = ["l_orderkey", "l_linenumber"]
    first = materialize(audit.file_digests(spark, f"{d}/lineitem.parquet", columns, portable=True), "file-digests")
    return audit.merged_fingerprint(audit.file_digests(spark, f"{d}/lineitem.parquet", columns, first, portable=True))


@query("malformed_records", f"""SELECT CASE WHEN o_orderkey % {NULL_PERIOD} = 1 THEN 'too_many_fields' ELSE 'too_few_fields' END AS reason,
 CASE WHEN o_orderkey % {NULL_PERIOD} = 1 THEN 4 ELSE 2 END AS fields, 3 AS expected, COUNT(*) AS records
 FROM orders WHERE o_orderkey % {NULL_PERIOD} IN (1, 2) GROUP BY ALL""")
def malformed_records(spark, d):
    """Records of the orders as CSV, some with a field too many or too few."""
    r, path = F.col("o_orderkey") % NULL_PERIOD, shared_dir(spark, "malformed")
    fields = F.when(r == 1, F.array("key", "status", F.lit('"a, b"'), F.lit("x"))).when(r == 2, F.array("key", "status")).otherwise(
        F.array("key", "status", F.lit('"a, b"')))
    lines = (table(spark, d, "orders").withColumns({"key": F.col("o_orderkey").cast("string"), "status": F.col("o_orderstatus")})
             .select(F.array_join(fields, ",").alias("o_orderkey,o_orderstatus,note")))
    # Written as one column, so that the lines stay as they are.
    lines.write.option("header", True).option("sep", "|").option("quote", "").csv(path)
    return malformed_rows(spark, path).groupBy("reason", "fields", "expected").agg(F.count(F.lit(1)).alias("records"))


@query("provenance_check", sql(
    f"""SELECT 'as recorded' AS record, COUNT(*) AS rows, CAST(SUM(Class) AS BIGINT) AS frauds, {_DIGEST} AS digest, TRUE AS as_expected FROM tx
 UNION ALL SELECT 'a row fewer', COUNT(*), CAST(SUM(Class) AS BIGINT), {_DIGEST}, FALSE FROM tx
 UNION ALL SELECT 'other digest', COUNT(*), CAST(SUM(Class) AS BIGINT), {_DIGEST}, FALSE FROM tx""", "tx"))
def provenance_check(spark, d):
    """The table against its own record and against two that are wrong."""
    tx = transactions(spark, d)
    expected = audit.fingerprint(tx, [ROW_ID, TARGET], portable=True).first()
    frauds = tx.where(F.col(TARGET) == 1).count()
    records = {"as recorded": (expected["rows"], expected["digest"]), "a row fewer": (expected["rows"] - 1, expected["digest"]),
               "other digest": (expected["rows"], expected["digest"] + 1)}
    out = None
    for name, (rows, digest) in records.items():
        one = audit.provenance(tx, rows, frauds, digest, [ROW_ID, TARGET], portable=True).withColumn("record", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# --- splits, samples, folds ---------------------------------------------------------------

@query("split_members", sql('SELECT row_id, "partition" FROM split', "split"))
def split_members(spark, d):
    return split.membership(split.stratified_split(transactions(spark, d)))


@query("split_summary", sql(f"""SELECT "partition", COUNT(*) AS rows, COUNT(*) FILTER (Class = 0) AS legitimate,
 COUNT(*) FILTER (Class = 1) AS frauds, {rnd("AVG(Class)", "fraud_rate", 8)} FROM split GROUP BY 1""", "split"))
def split_summary(spark, d):
    return rounded(split.split_summary(split.stratified_split(transactions(spark, d))), 8)


@query("split_overlap", sql("""SELECT COUNT(*) AS keys, COUNT(*) FILTER (lo <> hi) AS in_several_partitions,
 COUNT(*) FILTER (n > 1) AS repeated_keys FROM (SELECT row_id, MIN("partition") AS lo, MAX("partition") AS hi,
 COUNT(*) AS n FROM split GROUP BY row_id)""", "split"))
def split_overlap(spark, d):
    return split.split_overlap(split.membership(split.stratified_split(transactions(spark, d))))


_SHARED = [("train", "validation"), ("train", "test"), ("validation", "test")]


@query("split_intersections", sql(union(
    f"""SELECT '{a}' AS a, '{b}' AS b, COUNT(*) AS shared FROM (SELECT row_id FROM split WHERE "partition" = '{a}'
 INTERSECT SELECT row_id FROM split WHERE "partition" = '{b}')""" for a, b in _SHARED), "split"))
def split_intersections(spark, d):
    members = split.membership(split.stratified_split(transactions(spark, d)))
    out = None
    for a, b in _SHARED:
        one = split.shared_keys(members, a, b).agg(F.count(F.lit(1)).alias("shared")).select(
            F.lit(a).alias("a"), F.lit(b).alias("b"), "shared")
        out = one if out is None else out.unionByName(one)
    return out


SAMPLE_SHARE = 0.3


@query("bounded_sample", sql(f"""SELECT r.row_id, r.Class FROM (SELECT row_id, Class, {RANKED} AS r FROM tx) r,
 (SELECT *, (2 * k * p + n) // (2 * n) AS kp FROM (SELECT *, CAST(FLOOR({SAMPLE_SHARE} * n) AS BIGINT) AS k FROM tot)) q
 WHERE r.r <= CASE WHEN r.Class = 1 THEN kp ELSE k - kp END""", "tx", "tot"))
def bounded_sample(spark, d):
    tx = transactions(spark, d)
    return split.bounded_sample(tx, int(SAMPLE_SHARE * tx.count())).select(ROW_ID, TARGET)


@query("kfold_members", sql("SELECT row_id, fold FROM folds", "tx", "tot", extra=[("folds", FOLDED)]))
def kfold_members(spark, d):
    return split.stratified_folds(transactions(spark, d), 3).select(ROW_ID, "fold")


@query("fold_summary", sql("""SELECT fold, CAST(SUM(n) OVER () - n AS BIGINT) AS train_rows,
 CAST(SUM(p) OVER () - p AS BIGINT) AS train_frauds, n AS validation_rows, p AS validation_frauds
 FROM (SELECT fold, COUNT(*) AS n, CAST(SUM(Class) AS BIGINT) AS p FROM folds GROUP BY fold)""", "tx", "tot",
                         extra=[("folds", FOLDED)]))
def fold_summary(spark, d):
    return split.fold_summary(split.stratified_folds(transactions(spark, d), 3))


@query("majority_cap", sql(f"SELECT row_id, Class FROM (SELECT row_id, Class, {RANKED} AS r FROM tx) WHERE Class = 1 OR r <= 3000", "tx"))
def majority_cap(spark, d):
    return split.class_quota_sample(transactions(spark, d), {0: 3000, 1: None}).select(ROW_ID, TARGET)


@query("class_examples", sql("""SELECT row_id, Class, Amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Class ORDER BY row_id) AS r
 FROM split WHERE "partition" = 'test') WHERE r <= 3""", "split"))
def class_examples(spark, d):
    test = split.stratified_split(transactions(spark, d)).where("partition = 'test'")
    return split.first_rows_per_class(test).select(ROW_ID, TARGET, "Amount")


@query("hash_uniform", sql(f"SELECT row_id, CAST('0x' || substr({hash_sql('row_id')}, 1, 13) AS BIGINT)::DOUBLE / {2**52}::DOUBLE AS u FROM tx", "tx"))
def hash_uniform(spark, d):
    from rareclass.functions.hashing import hash_key, hash_unit
    return transactions(spark, d).select(ROW_ID, hash_unit(hash_key(42, F.col(ROW_ID))).alias("u"))
