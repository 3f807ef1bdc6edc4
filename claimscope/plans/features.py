"""Feature, encoding, feature-table, lineage and key-set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope.operators import feature_table as ft
from claimscope.operators import features, key_filter, relational
from claimscope.plans.registry import define, query, quoted
from claimscope.schema import FINAL_COLUMNS, RAW_SCHEMA
from claimscope.session import fresh_dir
from claimscope.sources.feature_store import FeatureStore, from_payload, to_payload
from claimscope.sources.tables import base, claims, once, relation

_FORMULAS = {
    "claim_to_premium_ratio": "total_claim_amount / (policy_annual_premium + 1)",
    "vehicle_property_ratio": "vehicle_claim / (property_claim + 1)",
    "injury_ratio": "injury_claim / (total_claim_amount + 1)",
    "tenure_age_ratio": "months_as_customer / (age * 12 + 1)",
    "no_witness_injury": "CASE WHEN bodily_injuries > 0 AND witnesses = 0 THEN 1 ELSE 0 END",
    "complex_no_witness": "CASE WHEN number_of_vehicles_involved > 1 AND witnesses = 0 THEN 1 ELSE 0 END",
    "deductible_claim_ratio": "policy_deductable / (total_claim_amount + 1)",
    "net_capital": '"capital-gains" - "capital-loss"',
}
_KEYS = {
    "feat_claim_to_premium": "claim_to_premium_ratio",
    "feat_vehicle_property": "vehicle_property_ratio",
    "feat_injury_ratio": "injury_ratio",
    "feat_tenure_age": "tenure_age_ratio",
    "feat_no_witness_injury": "no_witness_injury",
    "feat_complex_no_witness": "complex_no_witness",
    "feat_deductible_ratio": "deductible_claim_ratio",
    "feat_net_capital": "net_capital",
}


def _feature_query(key: str, name: str) -> None:
    @query(key, f"SELECT policy_number, total_claim_amount, {_FORMULAS[name]} AS {name} FROM claims", ["claims"])
    def run(spark, sf_dir):
        return features.add_features(claims(spark, sf_dir)).select("policy_number", "total_claim_amount", name)


for _key, _name in _KEYS.items():
    _feature_query(_key, _name)


def raw(spark, sf_dir):
    return relation(spark, sf_dir, "claims_raw")


_D = {c: f"coalesce(CAST({quoted(c)} AS DOUBLE), {d})" for c, d in features.ROW_DEFAULTS.items()}
_ROW_SQL = {
    "claim_to_premium_ratio": f"{_D['total_claim_amount']} / ({_D['policy_annual_premium']} + 1)",
    "vehicle_property_ratio": f"{_D['vehicle_claim']} / ({_D['property_claim']} + 1)",
    "injury_ratio": f"{_D['injury_claim']} / ({_D['total_claim_amount']} + 1)",
    "tenure_age_ratio": f"{_D['months_as_customer']} / ({_D['age']} * 12 + 1)",
    "no_witness_injury": f"CASE WHEN {_D['bodily_injuries']} > 0 AND {_D['witnesses']} = 0 THEN 1 ELSE 0 END",
    "complex_no_witness": f"CASE WHEN {_D['number_of_vehicles_involved']} > 1 AND {_D['witnesses']} = 0 THEN 1 ELSE 0 END",
    "deductible_claim_ratio": f"{_D['policy_deductable']} / ({_D['total_claim_amount']} + 1)",
    "net_capital": f"{_D['capital-gains']} - {_D['capital-loss']}",
    "is_new_customer": f"CASE WHEN {_D['months_as_customer']} < 12 THEN 1 ELSE 0 END",
    "is_high_value_claim": f"CASE WHEN {_D['total_claim_amount']} > 20000 THEN 1 ELSE 0 END",
}


@query("feat_new_customer", f"SELECT policy_number, months_as_customer, {_ROW_SQL['is_new_customer']} AS is_new_customer FROM claims_raw",
       ["claims_raw"])
def feat_new_customer(spark, sf_dir):
    return features.feature_rows(raw(spark, sf_dir), ["policy_number", "months_as_customer"]).select(
        "policy_number", "months_as_customer", "is_new_customer")


@query("feat_high_value", f"SELECT policy_number, total_claim_amount, {_ROW_SQL['is_high_value_claim']} AS is_high_value_claim FROM claims_raw",
       ["claims_raw"])
def feat_high_value(spark, sf_dir):
    return features.feature_rows(raw(spark, sf_dir), ["policy_number", "total_claim_amount"]).select(
        "policy_number", "total_claim_amount", "is_high_value_claim")


@query("feature_row", "SELECT policy_number, " + ", ".join(f"{v} AS {k}" for k, v in _ROW_SQL.items())
       + ", incident_type AS kept_incident_type FROM claims_raw", ["claims_raw"])
def feature_row(spark, sf_dir):
    return features.feature_rows(raw(spark, sf_dir), ["policy_number"]).withColumn(
        "kept_incident_type", F.col("_claim_data.incident_type")).drop("_claim_data")


TEXT_FEATURES = ["policy_state", "policy_csl", "insured_sex", "insured_education_level", "insured_occupation",
                 "incident_type", "collision_type", "incident_severity", "property_damage",
                 "police_report_available", "auto_make", "age_group", "tenure_group"]


def _dictionary_sql(source: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS feature, coalesce({c}, 'nan') AS value FROM {source}" for c in TEXT_FEATURES)
    return f"SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code FROM ({union})"


def _code_sql(column: str, dictionary: str) -> str:
    return (f"coalesce((SELECT d.code FROM {dictionary} d WHERE d.feature = '{column}' "
            f"AND d.value = coalesce(s.{column}, 'nan')), 0) AS {column}")


define("label_dictionary", _dictionary_sql("claims"), ["claims"])
define("early_dictionary", _dictionary_sql("(SELECT * FROM claims WHERE policy_state <> 'Ny' AND auto_make < 'N')"), ["claims"])


@query("encode_labels", "SELECT policy_number, total_claim_amount, " + ", ".join(_code_sql(c, "label_dictionary") for c in TEXT_FEATURES)
       + " FROM claims s", ["label_dictionary"])
def encode_labels(spark, sf_dir):
    df = claims(spark, sf_dir).select("policy_number", "total_claim_amount", *TEXT_FEATURES)
    return features.encode_labels(df, features.fit_labels(df, TEXT_FEATURES), TEXT_FEATURES)


@query("encode_unseen", "SELECT policy_number, total_claim_amount, " + ", ".join(_code_sql(c, "early_dictionary") for c in TEXT_FEATURES)
       + " FROM claims s", ["early_dictionary"])
def encode_unseen(spark, sf_dir):
    """Dictionary from claims without one state and without the later makes, applied to all claims."""
    df = claims(spark, sf_dir).select("policy_number", "total_claim_amount", *TEXT_FEATURES)
    known = df.filter("policy_state <> 'Ny' AND auto_make < 'N'")
    return features.encode_labels(df, features.fit_labels(known, TEXT_FEATURES), TEXT_FEATURES)


_LACKING = ["vehicle_claim", "property_claim", "capital-gains", "capital-loss", "collision_type"]


@query("fill_missing_features", "SELECT policy_number, "
       + ", ".join(f"0.0::DOUBLE AS {quoted(c)}" if c in _LACKING else quoted(c) for c in FINAL_COLUMNS if c != "policy_number") + ", "
       + ", ".join(f"{v} AS {k}" for k, v in {**_FORMULAS, "vehicle_property_ratio": "0.0::DOUBLE", "net_capital": "0.0::DOUBLE"}.items())
       + " FROM claims", ["claims"])
def fill_missing_features(spark, sf_dir):
    thin = claims(spark, sf_dir).drop(*_LACKING)
    return features.fill_missing_features(thin, FINAL_COLUMNS)


# --- feature table

define("feature_table", """SELECT feature_group, entity_id, stored_at, seq, total_claim_amount, stored_at + INTERVAL 3600 SECOND AS expires_at
  FROM (SELECT *, row_number() OVER (PARTITION BY feature_group, entity_id ORDER BY stored_at DESC, seq DESC) AS n FROM feature_writes)
  WHERE n = 1""", ["feature_writes"])
NOW_FEATURES = "2001-08-01 00:30:00"


def _now():
    return F.expr(f"TIMESTAMP_NTZ '{NOW_FEATURES}'")


def _table(spark, sf_dir):
    return ft.upsert(None, relation(spark, sf_dir, "feature_writes"), ["stored_at", "seq"])


@query("fs_upsert", "SELECT * FROM feature_table", ["feature_table"])
def fs_upsert(spark, sf_dir):
    """Two batches of writes, the second on top of the stored result of the first."""
    writes = relation(spark, sf_dir, "feature_writes")
    early = F.col("stored_at") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'")
    table = ft.upsert(None, writes.filter(early), ["stored_at", "seq"])
    return ft.upsert(table, writes.filter(~early), ["stored_at", "seq"])


@query("fs_get", f"""SELECT * FROM feature_table WHERE feature_group = 'claims' AND expires_at > TIMESTAMP '{NOW_FEATURES}'
  AND entity_id = (SELECT entity_id FROM feature_writes ORDER BY stored_at DESC, seq DESC LIMIT 1)""", ["feature_table"])
def fs_get(spark, sf_dir):
    """The entity written last."""
    writes = relation(spark, sf_dir, "feature_writes")
    wanted = writes.agg(F.max_by("entity_id", F.struct("stored_at", "seq"))).scalar()
    return ft.get(_table(spark, sf_dir), wanted, "claims", _now())


@query("fs_delete", """SELECT * FROM feature_table
  WHERE entity_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""", ["feature_table"])
def fs_delete(spark, sf_dir):
    closed = base(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("entity_id"))
    return ft.delete(_table(spark, sf_dir), closed)


_RECORD = [f.name for f in RAW_SCHEMA]


@query("fs_entity_id", "SELECT policy_number, incident_date, policy_number AS entity_id, 32 AS id_length, coalesce(collision_type, 'hashed') AS patched_id, count(*) OVER (PARTITION BY "
       + ", ".join(quoted(c) for c in _RECORD) + ") AS same_id FROM claims_raw", ["claims_raw"])
def fs_entity_id(spark, sf_dir):
    """Ids by key, by the whole record, and by record where the key is missing; a hashed id is shared by equal records only."""
    rows = raw(spark, sf_dir).select(
        "policy_number", "incident_date", ft.entity_id("policy_number", _RECORD).alias("entity_id"),
        ft.entity_id(None, _RECORD).alias("hashed_id"), ft.entity_id("collision_type", _RECORD).alias("patched_id"))
    same = rows.groupBy("hashed_id").agg(F.count("*").alias("same_id"))
    patched = F.when(F.col("patched_id") == F.col("hashed_id"), F.lit("hashed")).otherwise(F.col("patched_id"))
    return rows.join(same, "hashed_id").select("policy_number", "incident_date", "entity_id", F.length("hashed_id").alias("id_length"),
                                               patched.alias("patched_id"), "same_id")


@query("fs_batch_store", """SELECT count(*) AS stored, 0::BIGINT AS failed, count(*) AS total,
  count(DISTINCT policy_number) AS entities FROM claims_raw""", ["claims_raw"])
def fs_batch_store(spark, sf_dir):
    rows, summary = ft.batch_store(raw(spark, sf_dir), F.col("incident_date"))
    table = ft.upsert(None, rows)
    return summary.withColumn("entities", table.select(F.count("*")).scalar())


@query("fs_stats", f"""SELECT feature_group, count(*) AS stored_features, count(*) FILTER (expires_at > TIMESTAMP '{NOW_FEATURES}') AS live,
  count(*) FILTER (expires_at <= TIMESTAMP '{NOW_FEATURES}') AS expired FROM feature_table GROUP BY feature_group""", ["feature_table"])
def fs_stats(spark, sf_dir):
    return ft.stats(_table(spark, sf_dir), _now())


def _buckets(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _kept(spark, sf_dir):
    """The kept table of all writes, landed and folded once."""
    def build(path):
        store = FeatureStore(spark, path, _buckets(spark))
        store.upsert(relation(spark, sf_dir, "feature_writes"), "all")
        store.fold()
    return FeatureStore(spark, once(spark, sf_dir, "feature_store", build))


def _customers(spark, sf_dir):
    return base(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"), "c_acctbal")


@query("lookup_batch_features", """SELECT CAST(c_custkey AS VARCHAR) AS entity_id, t.stored_at, t.seq, t.total_claim_amount, t.expires_at
  FROM customer LEFT JOIN feature_table t ON t.entity_id = CAST(c_custkey AS VARCHAR) AND t.feature_group = 'claims'""", ["feature_table"])
def lookup_batch_features(spark, sf_dir):
    found = _kept(spark, sf_dir).lookup(_customers(spark, sf_dir), "claims")
    return from_payload(found, "total_claim_amount double").drop("rejected")


_EARLY_WRITE = "stored_at < TIMESTAMP_NTZ '1998-07-01 00:00:00'"


def _two_runs(spark, sf_dir):
    """One run lands and folds the early writes; another, which knows the folder only, lands the late ones."""
    path, writes = fresh_dir(spark, "two_runs"), relation(spark, sf_dir, "feature_writes")
    first = FeatureStore(spark, path, _buckets(spark))
    first.upsert(writes.filter(_EARLY_WRITE), "early")
    first.fold()
    second = FeatureStore(spark, path)
    second.upsert(writes.filter(f"NOT ({_EARLY_WRITE})"), "late")
    return FeatureStore(spark, path)


@query("fs_store_upsert", "SELECT * FROM feature_table", ["feature_table"])
def fs_store_upsert(spark, sf_dir):
    """What a third run sees of two others: folded rows and an open batch."""
    return from_payload(_two_runs(spark, sf_dir).current(), "total_claim_amount double").drop("rejected")


@query("fs_store_fold", "SELECT *, 2::BIGINT AS version FROM feature_table", ["feature_table"])
def fs_store_fold(spark, sf_dir):
    """The same after the second fold, which finds the late batch landed twice."""
    store = _two_runs(spark, sf_dir)
    store.upsert(relation(spark, sf_dir, "feature_writes").filter(f"NOT ({_EARLY_WRITE})"), "late")
    version = store.fold()
    return from_payload(store.current(), "total_claim_amount double").drop("rejected").withColumn("version", F.lit(version).cast("bigint"))


@query("fs_store_delete", """SELECT * FROM feature_table WHERE stored_at > TIMESTAMP '2000-01-01 00:00:00'
  OR entity_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""", ["feature_table"])
def fs_store_delete(spark, sf_dir):
    """Entities with a debt are removed as of a day: what they stored later stays."""
    store = _two_runs(spark, sf_dir)
    store.delete(_customers(spark, sf_dir).filter("c_acctbal < 0"), "closed", F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'"), "claims")
    store.fold()
    return from_payload(store.current(), "total_claim_amount double").drop("rejected")


@query("fs_payload", """WITH w AS (SELECT *, stored_at < TIMESTAMP '1998-07-01 00:00:00' AS early, seq % 7 = 3 AND stored_at >= TIMESTAMP '1998-07-01 00:00:00' AS bad FROM feature_writes),
  kept AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY stored_at DESC, seq DESC) AS n FROM w WHERE NOT bad)
  SELECT entity_id, stored_at, total_claim_amount, CASE WHEN NOT early THEN seq * 2 END AS doubled, (SELECT count(*) FROM w WHERE bad) AS rejects FROM kept WHERE n = 1""",
       ["feature_writes"])
def fs_payload(spark, sf_dir):
    """Payloads of an older schema, of a newer one with a further feature, and cut ones, which are rejected."""
    store, writes = FeatureStore(spark, fresh_dir(spark, "payloads"), _buckets(spark)), relation(spark, sf_dir, "feature_writes")
    store.upsert(writes.filter(_EARLY_WRITE), "old")
    store.fold()
    late = writes.filter(f"NOT ({_EARLY_WRITE})").withColumn("doubled", F.col("seq") * 2)
    text = to_payload(late)
    cut = F.when(F.col("seq") % 7 == 3, F.expr("left(features, length(features) - 9)")).otherwise(F.col("features"))
    _, bad = store.upsert_payloads(text.withColumn("features", cut), "new", "total_claim_amount double, doubled bigint")
    found = from_payload(store.current(), "total_claim_amount double, doubled bigint")
    return found.select("entity_id", "stored_at", "total_claim_amount", "doubled", F.lit(bad).cast("bigint").alias("rejects"))


# --- lineage

define("lineage_nodes", """SELECT node_id, name, source, written_at FROM (SELECT *, row_number() OVER (PARTITION BY node_id
  ORDER BY written_at DESC, name DESC, source DESC) AS n FROM lineage_node_writes) WHERE n = 1""", ["lineage_node_writes"])


def _lineage(spark, sf_dir):
    return relation(spark, sf_dir, "lineage_node_writes"), relation(spark, sf_dir, "lineage_edges")


@query("lineage_upstream", """SELECT n.node_id, e.transformation, n.name, n.source, n.written_at
  FROM lineage_edges e JOIN lineage_nodes n ON n.node_id = e.from_node WHERE e.to_node = 'order:1'""", ["lineage_edges", "lineage_nodes"])
def lineage_upstream(spark, sf_dir):
    return relational.upstream(*_lineage(spark, sf_dir), "order:1")


@query("lineage_downstream", """SELECT n.node_id, e.transformation, n.name, n.source, n.written_at
  FROM lineage_edges e JOIN lineage_nodes n ON n.node_id = e.to_node WHERE e.from_node = 'part:1'""", ["lineage_edges", "lineage_nodes"])
def lineage_downstream(spark, sf_dir):
    return relational.downstream(*_lineage(spark, sf_dir), "part:1")


_GRAPH_SQL = """SELECT from_node, to_node FROM lineage_edges
  UNION ALL SELECT concat('order:', CAST(o_orderkey AS VARCHAR)), concat('customer:', CAST(o_custkey AS VARCHAR)) FROM orders
  UNION ALL SELECT concat('customer:', CAST(c_custkey AS VARCHAR)), concat('nation:', CAST(c_nationkey AS VARCHAR)) FROM customer
  UNION ALL SELECT concat('nation:', CAST(c_nationkey AS VARCHAR)), concat('customer:', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_custkey % 3 = 0"""
define("lineage_graph", _GRAPH_SQL, ["lineage_edges"])


def _graph(spark, sf_dir):
    """Parts, orders, customers and nations, with edges back to some customers, so that there are cycles."""
    def edges(df, a, b, x, y):
        return df.select(F.concat(F.lit(a + ":"), F.col(x).cast("string")).alias("from_node"), F.concat(F.lit(b + ":"), F.col(y).cast("string")).alias("to_node"))

    orders, customer = base(spark, sf_dir, "orders"), base(spark, sf_dir, "customer")
    return (relation(spark, sf_dir, "lineage_edges").select("from_node", "to_node").unionByName(edges(orders, "order", "customer", "o_orderkey", "o_custkey"))
            .unionByName(edges(customer, "customer", "nation", "c_custkey", "c_nationkey"))
            .unionByName(edges(customer.filter("c_custkey % 3 = 0"), "nation", "customer", "c_nationkey", "c_custkey")))


def _hops_sql(start: str, here: str, there: str, hops: int) -> str:
    return f"""WITH RECURSIVE reached(node_id, hops) AS (SELECT {there}, 1 FROM lineage_graph WHERE {here} = '{start}'
  UNION SELECT g.{there}, r.hops + 1 FROM reached r JOIN lineage_graph g ON g.{here} = r.node_id WHERE r.hops < {hops})
  SELECT n.node_id, r.hops, n.name, n.source, n.written_at FROM (SELECT node_id, CAST(min(hops) AS INTEGER) AS hops FROM reached GROUP BY node_id) r
  JOIN lineage_nodes n ON n.node_id = r.node_id WHERE r.node_id <> '{start}'"""


@query("lineage_upstream_all", _hops_sql("nation:7", "to_node", "from_node", 6), ["lineage_graph", "lineage_nodes"])
def lineage_upstream_all(spark, sf_dir):
    """Orders and parts behind a nation, over all hops; customers have no entry of their own and are passed through."""
    return relational.all_upstream(relation(spark, sf_dir, "lineage_node_writes"), _graph(spark, sf_dir), "nation:7").select(
        "node_id", "hops", "name", "source", "written_at")


@query("lineage_downstream_hops", _hops_sql("part:1", "from_node", "to_node", 1), ["lineage_graph", "lineage_nodes"])
def lineage_downstream_hops(spark, sf_dir):
    return relational.all_downstream(relation(spark, sf_dir, "lineage_node_writes"), _graph(spark, sf_dir), "part:1", hops=1).select(
        "node_id", "hops", "name", "source", "written_at")


@query("lineage_upsert", "SELECT * FROM lineage_nodes", ["lineage_nodes"])
def lineage_upsert(spark, sf_dir):
    return relational.upsert_nodes(relation(spark, sf_dir, "lineage_node_writes"))


# --- key sets

_EARLY = "incident_date < TIMESTAMP '1998-07-01 00:00:00'"


def _early(df):
    return df.filter(F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'"))


@query("append_rows", "SELECT * FROM drift_ref UNION ALL SELECT * FROM drift_new", ["drift_ref", "drift_new"])
def append_rows(spark, sf_dir):
    return relational.append_rows(relation(spark, sf_dir, "drift_ref"), relation(spark, sf_dir, "drift_new"))


@query("set_union_processed", f"""SELECT policy_number FROM claims_raw WHERE {_EARLY}
  UNION SELECT policy_number FROM claims_raw WHERE incident_date >= TIMESTAMP '1997-01-01 00:00:00'""", ["claims_raw"])
def set_union_processed(spark, sf_dir):
    df = raw(spark, sf_dir)
    late = df.filter(F.col("incident_date") >= F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))
    return relational.union_keys(_early(df).select("policy_number"), late.select("policy_number"))


@query("skip_processed", f"""SELECT policy_number, incident_date, total_claim_amount FROM claims_raw
  WHERE policy_number NOT IN (SELECT policy_number FROM claims_raw WHERE {_EARLY})""", ["claims_raw"])
def skip_processed(spark, sf_dir):
    df = raw(spark, sf_dir).select("policy_number", "incident_date", "total_claim_amount")
    return relational.skip_processed(df, _early(df), "policy_number")


@query("skip_processed_filter", f"""SELECT policy_number, incident_date, total_claim_amount FROM claims_raw
  WHERE policy_number NOT IN (SELECT policy_number FROM claims_raw WHERE {_EARLY})""", ["claims_raw"])
def skip_processed_filter(spark, sf_dir):
    """The same rows through the filters of two loads, merged: only what they may hold meets the processed keys."""
    df = raw(spark, sf_dir).select("policy_number", "incident_date", "total_claim_amount")
    done = _early(df)
    first = F.col("total_claim_amount") < 100000
    filters = key_filter.build(done.filter(first), "policy_number").unionByName(key_filter.build(done.filter(~first), "policy_number"))
    return relational.skip_processed(df, done, "policy_number", key_filter.merge(filters))


@query("max_watermark", f"SELECT max(policy_number) AS watermark FROM claims_raw WHERE {_EARLY}", ["claims_raw"])
def max_watermark(spark, sf_dir):
    return relational.max_watermark(_early(raw(spark, sf_dir)), "policy_number")


@query("filter_above_watermark", """SELECT policy_number, incident_date, total_claim_amount FROM claims_raw
  WHERE policy_number > (SELECT max(policy_number) FROM claims_raw WHERE incident_date < TIMESTAMP '1995-01-03 00:00:00')""", ["claims_raw"])
def filter_above_watermark(spark, sf_dir):
    df = raw(spark, sf_dir).select("policy_number", "incident_date", "total_claim_amount")
    done = df.filter(F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1995-01-03 00:00:00'"))
    return relational.above_watermark(df, "policy_number", relational.max_watermark(done, "policy_number").first()[0])
