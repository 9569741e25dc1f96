"""Sub-queries, CTEs, functions in Python and SQL (Q)."""

import pandas as pd
from pyspark.sql import functions as F

from spindrift.functions.numeric import dec
from spindrift.operators import graph, text
from spindrift.operators.sets import diff_rows
from spindrift.plans import retail
from spindrift.queries import query
from spindrift.queries.jobs import LOYALTY
from spindrift.queries.snippets import davg

CTE = """
WITH per AS (SELECT o_custkey, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS spend FROM orders GROUP BY o_custkey),
named AS (SELECT c_custkey, n_name, spend, n FROM per JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
ranked AS (SELECT n_name, c_custkey, n, CAST(spend AS DOUBLE) AS spend, CAST(RANK() OVER (PARTITION BY n_name ORDER BY spend DESC) AS INTEGER) AS rnk FROM named)
SELECT n_name, c_custkey, n, spend, rnk FROM ranked WHERE rnk <= 5"""


@query("q01_multi_step_cte", CTE)
def q01(spark, t):
    t.views("orders", "customer", "nation")
    return spark.sql(CTE)


SCALAR = f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1.8 * (SELECT {davg('o_totalprice')} FROM orders)"""


@query("q02_scalar_subquery", SCALAR)
def q02(spark, t):
    t.views("orders")
    return spark.sql(SCALAR.replace("1.8", "1.8D"))


CORRELATED = """
SELECT c_custkey, c_name, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS order_count FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)"""


@query("q03_correlated", CORRELATED)
def q03(spark, t):
    t.views("orders", "customer")
    return spark.sql(CORRELATED)


EDGES = """
SELECT DISTINCT 'region:' || r_name AS src, 'nation:' || n_name AS dst FROM region JOIN nation ON n_regionkey = r_regionkey
UNION SELECT DISTINCT 'nation:' || n_name, 'segment:' || n_name || '/' || c_mktsegment FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION SELECT DISTINCT 'segment:' || n_name || '/' || c_mktsegment, 'market:' || c_mktsegment FROM nation JOIN customer ON c_nationkey = n_nationkey"""


def edges(spark, t):
    """Lineage edges region -> nation -> segment of the nation -> market, derived from the tables."""
    t.views("region", "nation", "customer")
    return spark.sql(EDGES)


IMPACT = f"""
WITH RECURSIVE e AS ({EDGES}),
r AS (SELECT 'region:EUROPE' AS node, 0 AS depth UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1"""


@query("q04_impact", IMPACT)
def q04(spark, t):
    return graph.impact(edges(spark, t), spark.sql("SELECT 'region:EUROPE' AS node"))


@query("q04_recursive_cte", IMPACT)
def q04_cte(spark, t):
    t.views("region", "nation", "customer")
    return spark.sql(f"""
        WITH RECURSIVE e AS ({EDGES}),
        r AS (SELECT 'region:EUROPE' AS node, 0 AS depth
              UNION ALL SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node)
        SELECT node, min(depth) AS depth FROM r GROUP BY node""")


TIER = """
SELECT c_custkey, CASE WHEN c_acctbal >= 7500 THEN 'GOLD' WHEN c_acctbal >= 2500 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM customer"""


def tier_of(balance: float) -> str:
    if balance is not None and balance >= 7500:
        return "GOLD"
    return "SILVER" if balance is not None and balance >= 2500 else "BRONZE"


def native_tier(c):
    return F.when(F.col(c) >= 7500, "GOLD").when(F.col(c) >= 2500, "SILVER").otherwise("BRONZE")


@query("q05_python_udf", TIER)
def q05(spark, t):
    # the row-at-a-time form the inventory asks for; native_tier is the one to use
    return t.customer.select("c_custkey", F.udf(tier_of, "string")("c_acctbal").alias("tier"))


def pandas_tier(balance: pd.Series) -> pd.Series:
    # a missing balance is the lowest tier, as in the other forms
    return pd.cut(balance.fillna(-float("inf")), [-float("inf"), 2500, 7500, float("inf")], right=False, labels=["BRONZE", "SILVER", "GOLD"]).astype(str)


@query("q06_pandas_udf", TIER)
def q06(spark, t):
    return t.customer.select("c_custkey", F.pandas_udf(pandas_tier, "string")("c_acctbal").alias("tier"))


@query("q07_sql_udf", TIER)
def q07(spark, t):
    t.views("customer")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION balance_tier(b DOUBLE) RETURNS STRING
                 RETURN CASE WHEN b >= 7500 THEN 'GOLD' WHEN b >= 2500 THEN 'SILVER' ELSE 'BRONZE' END""")
    return spark.sql("SELECT c_custkey, balance_tier(c_acctbal) AS tier FROM customer")


@query("q08_three_way_equality", """
SELECT form, COUNT(*) AS customers, CAST(0 AS BIGINT) AS differing FROM customer, (VALUES ('python'), ('pandas')) AS f(form) GROUP BY 1""")
def q08(spark, t):
    """Rows by which the Python and pandas forms differ from the native one."""
    native = t.customer.select("c_custkey", native_tier("c_acctbal").alias("tier"))
    out = None
    for form, other in (("python", q05(spark, t)), ("pandas", q06(spark, t))):
        gap = diff_rows(native, other, ["c_custkey", "tier"]).agg(F.count(F.lit(1)).alias("differing"))
        one = other.agg(F.count(F.lit(1)).alias("customers")).select(F.lit(form).alias("form"), "customers", gap.scalar().alias("differing"))
        out = one if out is None else out.unionByName(one)
    return out


# words that occur in the texts at hand
WORD_RULES = (("question", ("who", "what", "why")), ("modal", ("would", "could", "should")), ("place", ("there", "here", "where")),
              ("article", ("the ", "der ", "las ")))


@query("q09_keyword_classes", """
WITH x AS (SELECT doc_id, lower(text) AS s FROM documents)
SELECT doc_id, CASE WHEN contains(s, 'who') OR contains(s, 'what') OR contains(s, 'why') THEN 'question'
  WHEN contains(s, 'would') OR contains(s, 'could') OR contains(s, 'should') THEN 'modal'
  WHEN contains(s, 'there') OR contains(s, 'here') OR contains(s, 'where') THEN 'place'
  WHEN contains(s, 'the ') OR contains(s, 'der ') OR contains(s, 'las ') THEN 'article' ELSE 'other' END AS label FROM x""")
def q09(spark, t):
    return t.documents.select("doc_id", text.classify("text", WORD_RULES, "other").alias("label"))


@query("q09_ticket_classes", """
WITH x AS (SELECT conv_id, turn, lower(text) AS s FROM conversations)
SELECT conv_id, turn, CASE
  WHEN regexp_matches(s, 'billing|charge|refund|invoice|payment') THEN 'Billing'
  WHEN regexp_matches(s, 'login|password|account|cannot log') THEN 'Account Access'
  WHEN regexp_matches(s, 'error|bug|fail|down|503|500|broken') THEN 'Technical Issue'
  WHEN regexp_matches(s, 'security|vulnerability|patch|breach') THEN 'Security'
  WHEN regexp_matches(s, 'feature|request|add|enhancement') THEN 'Feature Request'
  WHEN regexp_matches(s, 'thank|great|amazing|love') THEN 'Positive Feedback' ELSE 'General Inquiry' END AS label FROM x""")
def q09_tickets(spark, t):
    return t.conversations.select("conv_id", "turn", text.classify("text").alias("label"))


@query("q10_entities", rf"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '{text.EMAIL}'), ' ') AS emails, array_to_string(regexp_extract_all(text, '{text.ISO_DATE}'), ' ') AS dates,
       CAST(len(regexp_extract_all(text, '{text.AMOUNT}')) AS INTEGER) AS amounts, CAST(len(regexp_extract_all(text, '{text.VERSION}')) AS INTEGER) AS versions
FROM documents""")
def q10(spark, t):
    found = text.extract_entities(t.documents.select("doc_id", "text"), "text")
    return found.select("doc_id", F.array_join("emails", " ").alias("emails"), F.array_join("dates", " ").alias("dates"),
                        F.size("amounts").alias("amounts"), F.size("versions").alias("versions"))


@query("q10_redact", rf"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{text.EMAIL}', '[EMAIL]', 'g'), '{text.SSN}', '[SSN]', 'g'), '{text.PHONE}', '[PHONE]', 'g') AS clean FROM documents""")
def q10_redact(spark, t):
    return t.documents.select("doc_id", text.redact_text("text").alias("clean"))


def load_word_model():
    """A deterministic stand-in for a model: scores a text by its share of long words."""
    def score(batch: pd.DataFrame) -> pd.DataFrame:
        words = batch["text"].str.split()
        total = words.str.len()
        long = words.map(lambda ws: sum(len(w) > 6 for w in ws))
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_words": total, "long_words": long})
    return score


@query("q11_batch_inference", r"""
WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS words FROM documents)
SELECT doc_id, len(words) AS n_words, len(list_filter(words, lambda x: length(x) > 6)) AS long_words FROM w""")
def q11(spark, t):
    return text.infer(t.documents, ["doc_id", "text"], load_word_model, "doc_id long, n_words long, long_words long")


@query("o14_loyalty_summary", f"WITH {LOYALTY} SELECT tier, COUNT(*) AS customers, CAST(SUM(spend) AS DOUBLE) AS spend FROM tiers JOIN loyal USING (c_custkey) GROUP BY 1")
def loyalty_summary(spark, t):
    return retail.loyalty(t).groupBy("tier").agg(F.count(F.lit(1)).alias("customers"), F.sum(dec("total_spend", 2, 18)).cast("double").alias("spend"))
