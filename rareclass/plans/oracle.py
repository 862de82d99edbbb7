"""Building blocks of the SQL that a second engine runs on the same tables."""

from __future__ import annotations

from rareclass.config import COMPONENTS, FEATURES, SEED
from rareclass.functions.scalars import MISSING_TOKENS
from rareclass.plans.fixture import COPY_PERIOD, NULL_PERIOD, SCORED_COMPONENTS, experiment_name, scorers


def _component(i: int) -> str:
    value = f"CAST(m.embedding[{i + 1}] AS DOUBLE)"
    if i < 3:
        value = f"CASE WHEN e.event_id % {NULL_PERIOD} <> {i + 1} THEN {value} END"
    return f"{value} AS {COMPONENTS[i]}"


def _logistic(bias: str, weights: list[str]) -> str:
    z = " + ".join([bias, *[f"{w} * COALESCE({c}, 0.0::DOUBLE)" for c, w in zip(SCORED_COMPONENTS, weights)]])
    return f"ROUND(1 / (1 + EXP(-({z}))), 4)"


def fixed_score_sql(key) -> str:
    bias, weights = scorers()[key]
    return _logistic(f"{bias}::DOUBLE", [f"({w})::DOUBLE" for w in weights])


_WEIGHT_NAMES = [f"w{i}" for i in range(len(SCORED_COMPONENTS))]
_WEIGHT_ROWS = ", ".join(
    "('%s', '%s', '%s', '%s', %s::DOUBLE, %s)" % (
        experiment_name(k), *k, bias, ", ".join(f"({w})::DOUBLE" for w in weights))
    for k, (bias, weights) in scorers().items())

_AMOUNT_TEXT = f"""CASE row_id % {NULL_PERIOD} WHEN 4 THEN 'N/A' WHEN 5 THEN '12,50' WHEN 6 THEN 'inf'
 WHEN 7 THEN '-' || CAST(Amount AS VARCHAR) WHEN 8 THEN '' ELSE CAST(Amount AS VARCHAR) END"""
_LABEL_TEXT = f"CASE row_id % {NULL_PERIOD} WHEN 9 THEN '2' WHEN 10 THEN '' ELSE CAST(Class AS VARCHAR) END"
_MISSING = ", ".join(f"'{t}'" for t in MISSING_TOKENS)


def text_missing(c: str) -> str:
    return f"({c} IS NULL OR TRIM({c}) IN ({_MISSING}))"


def text_number(c: str) -> str:
    return f"(CASE WHEN NOT {text_missing(c)} THEN TRY_CAST({c} AS DOUBLE) END)"


def hash_sql(*parts: str, seed=SEED) -> str:
    return "md5(concat_ws(':', '%s', %s))" % (seed, ", ".join(f"CAST({p} AS VARCHAR)" for p in parts))


def hash_int_sql(digits: int, h: str) -> str:
    return f"CAST('0x' || substr({h}, 1, {digits}) AS BIGINT)"


def hash_unit_sql(h: str) -> str:
    return f"({hash_int_sql(13, h)}::DOUBLE / {2**52}::DOUBLE)"


RANKED = f"ROW_NUMBER() OVER (PARTITION BY Class ORDER BY {hash_sql('row_id')}, row_id)"

def _fold_count(end: str, start: str, i: int) -> str:
    return f"(({end} - {i} + 2) // 3 - ({start} - {i} + 2) // 3)"


FOLDED = f"""SELECT r.row_id, r.Class, CAST(CASE WHEN r.r <= f1 THEN 1 WHEN r.r <= f1 + f2 THEN 2 ELSE 3 END AS INTEGER) AS fold
 FROM (SELECT row_id, Class, {RANKED} AS r FROM tx) r JOIN (
 SELECT 0 AS c, {_fold_count("(n - p)", "0", 0)} AS f1, {_fold_count("(n - p)", "0", 1)} AS f2 FROM tot UNION ALL
 SELECT 1, {_fold_count("n", "(n - p)", 0)}, {_fold_count("n", "(n - p)", 1)} FROM tot) s ON r.Class = s.c"""


def fold_score_sql() -> str:
    return _logistic("bias", _WEIGHT_NAMES)


CTES = {
    "z": "SELECT MIN(EPOCH_US(ts)) AS t0 FROM events",
    "nv": "SELECT COUNT(*) AS n FROM embeddings",
    "txts": f"""SELECT e.event_id AS row_id, e.ts, CAST(EPOCH_US(e.ts) - z.t0 AS DOUBLE) / 1000000 AS Time,
 {", ".join(_component(i) for i in range(28))}, e.value AS Amount,
 CASE WHEN m.label = 0 AND e.event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS Class
 FROM events e CROSS JOIN z CROSS JOIN nv JOIN embeddings m ON e.event_id % nv.n = m.vec_id""",
    "tx": "SELECT * EXCLUDE (ts) FROM txts",
    "raw": f"SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE row_id % {COPY_PERIOD} = 0",
    "texts": f"""SELECT row_id, {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in FEATURES[:-1])},
 {_AMOUNT_TEXT} AS Amount, {_LABEL_TEXT} AS Class FROM raw""",
    "tot": "SELECT COUNT(*) AS n, CAST(SUM(Class) AS BIGINT) AS p FROM tx",
    "dev": "SELECT *, (2 * n_dev * p + n) // (2 * n) AS dev_p FROM (SELECT *, n - CAST(CEIL(0.2 * n) AS BIGINT) AS n_dev FROM tot)",
    "quota": """SELECT *, (2 * n_train * dev_p + n_dev) // (2 * n_dev) AS train_p
 FROM (SELECT *, n_dev - CAST(CEIL(0.25 * n_dev) AS BIGINT) AS n_train FROM dev)""",
    "cuts": """SELECT 1 AS c, p - dev_p AS n_test, dev_p - train_p AS n_val FROM quota
 UNION ALL SELECT 0, (n - p) - (n_dev - dev_p), (n_dev - dev_p) - (n_train - train_p) FROM quota""",
    "split": f"""SELECT r.* EXCLUDE (r), CASE WHEN r.r <= n_test THEN 'test' WHEN r.r <= n_test + n_val THEN 'validation'
 ELSE 'train' END AS "partition" FROM (SELECT *, {RANKED} AS r FROM tx) r JOIN cuts ON r.Class = cuts.c""",
    "train": "SELECT * FROM split WHERE \"partition\" = 'train'",
    "weights": f"""SELECT * FROM (VALUES {_WEIGHT_ROWS}) AS t(experiment, algorithm, imbalance, stage, bias,
 {", ".join(_WEIGHT_NAMES)})""",
    "scores": f"""SELECT row_id, Class AS label, "partition", experiment, algorithm, imbalance, stage,
 {_logistic("bias", _WEIGHT_NAMES)} AS score FROM split CROSS JOIN weights""",
    "pts": """SELECT experiment, "partition", score, CAST(SUM(label) AS BIGINT) AS pos,
 CAST(SUM(1 - label) AS BIGINT) AS neg FROM scores WHERE "partition" <> 'train' GROUP BY ALL""",
    "cur": """SELECT *, CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(neg) OVER w AS BIGINT) AS fp,
 CAST(SUM(pos) OVER g AS BIGINT) AS p, CAST(SUM(neg) OVER g AS BIGINT) AS n,
 LEAD(pos) OVER o AS next_pos, LEAD(neg) OVER o AS next_neg FROM pts
 WINDOW g AS (PARTITION BY experiment, "partition"), o AS (PARTITION BY experiment, "partition" ORDER BY score DESC),
 w AS (PARTITION BY experiment, "partition" ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
    "areas": """SELECT experiment, "partition",
 SUM(neg * (tp - pos + pos / 2.0::DOUBLE)) / (MAX(p) * MAX(n))::DOUBLE AS roc_auc,
 SUM(pos * (tp::DOUBLE / (tp + fp))) / MAX(p)::DOUBLE AS average_precision,
 SUM(pos * ((CASE WHEN tp + fp - pos - neg = 0 THEN 1.0::DOUBLE ELSE (tp - pos)::DOUBLE / (tp + fp - pos - neg) END)
  + tp::DOUBLE / (tp + fp)) / 2.0::DOUBLE) / MAX(p)::DOUBLE AS pr_auc FROM cur GROUP BY ALL""",
    "conf": """SELECT experiment, "partition", COUNT(*) FILTER (score < 0.5 AND label = 0) AS tn,
 COUNT(*) FILTER (score >= 0.5 AND label = 0) AS fp, COUNT(*) FILTER (score < 0.5 AND label = 1) AS fn,
 COUNT(*) FILTER (score >= 0.5 AND label = 1) AS tp FROM scores WHERE "partition" <> 'train' GROUP BY ALL""",
}
NEEDS = {
    "txts": ["z", "nv"], "tx": ["txts"], "raw": ["tx"], "texts": ["raw"], "tot": ["tx"], "dev": ["tot"],
    "quota": ["dev"], "cuts": ["quota"], "split": ["tx", "cuts"], "train": ["split"], "scores": ["split", "weights"],
    "pts": ["scores"], "cur": ["pts"], "areas": ["cur"], "conf": ["scores"]}


def sql(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the named blocks and what they need, then ``body``."""
    order: list[str] = []

    def add(name: str):
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({t})" for n, t in extra or []]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def rnd(expr: str, alias: str | None = None, digits: int = 6) -> str:
    """Rounded as on the Spark side; adding zero removes a negative zero."""
    return f"ROUND({expr}, {digits}) + 0.0::DOUBLE AS {alias or expr}"


def union(selects) -> str:
    return " UNION ALL ".join(selects)




def rate_columns(digits: int = 6) -> str:
    return ", ".join([
        rnd("(tp + tn)::DOUBLE / (tp + tn + fp + fn)", "accuracy", digits),
        rnd("CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END", "precision", digits),
        rnd("CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END", "recall", digits),
        rnd("CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END", "f1", digits)])
