"""Registered queries: transactions, itemsets and rules.

Baskets are orders, items their parts' ``p_type``. At support 0.1 every scale
yields itemsets of size 1-3 only; the SQL oracle enumerates up to size 4 so a
larger set on the Spark side would show up as a mismatch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cvlens.functions.predicates import is_noise_skill_sql
from cvlens.functions.text import clean_text, split_words, strip_ws_sql, clean_text_sql, WS_RUN
from cvlens.operators.mining import (KEY_SEP, clean_transaction, mine_associations, top_rules,
                                     transactions)
from cvlens.plans.registry import joined, r6, register
from cvlens.sources.tables import documents, order_baskets, order_baskets_sql

MIN_SUPPORT = 0.1
# The API default is 0.5; at sf0.1 no rule reaches it on this data, so the
# registered queries ask for 0.4 (90 rules at every scale).
MIN_CONFIDENCE = 0.4


def _mined(spark, sf):
    return mine_associations(order_baskets(spark, sf), MIN_SUPPORT, MIN_CONFIDENCE)


_TX_SQL = f"""
tx AS (SELECT resume_id, list_filter(normalized_skills, lambda s: NOT {is_noise_skill_sql('s')}) AS items
       FROM {order_baskets_sql()}),
txn AS (SELECT * FROM tx WHERE len(items) > 0),
nn AS (SELECT count(*)::DOUBLE AS n, greatest({MIN_SUPPORT}, least(1.0, 2.0 / count(*))) AS s FROM txn),
ti AS (SELECT resume_id, unnest(items) AS item FROM txn),
raw_sets AS (
  SELECT [a.item] AS items, count(*) AS freq FROM ti a GROUP BY a.item
  UNION ALL
  SELECT [a.item, b.item], count(*) FROM ti a JOIN ti b ON a.resume_id = b.resume_id AND a.item < b.item
  GROUP BY a.item, b.item
  UNION ALL
  SELECT [a.item, b.item, c.item], count(*) FROM ti a
    JOIN ti b ON a.resume_id = b.resume_id AND a.item < b.item
    JOIN ti c ON a.resume_id = c.resume_id AND b.item < c.item
  GROUP BY a.item, b.item, c.item
  UNION ALL
  SELECT [a.item, b.item, c.item, d.item], count(*) FROM ti a
    JOIN ti b ON a.resume_id = b.resume_id AND a.item < b.item
    JOIN ti c ON a.resume_id = c.resume_id AND b.item < c.item
    JOIN ti d ON a.resume_id = d.resume_id AND c.item < d.item
  GROUP BY a.item, b.item, c.item, d.item),
sets AS (SELECT items, freq, freq / n AS support, n FROM raw_sets, nn WHERE freq / n >= s)"""

_RULES_SQL = f"""WITH {_TX_SQL},
splits AS (
  SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS ant,
         list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0) AS cons, freq AS f_ac, n
  FROM (SELECT items, freq, n, unnest(range(1, (1 << len(items)) - 1)) AS mask
        FROM sets WHERE len(items) >= 2)),
rules AS (
  SELECT s.ant, s.cons, s.f_ac / s.n AS support, (s.f_ac / s.n) / (a.freq / s.n) AS confidence,
         ((s.f_ac / s.n) / (a.freq / s.n)) / (c.freq / s.n) AS lift
  FROM splits s JOIN sets a ON a.items = s.ant JOIN sets c ON c.items = s.cons)"""

_RULE_COLS = """array_to_string(ant, '|') AS antecedents, array_to_string(cons, '|') AS consequents,
  round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"""


@register("effective_support", f"""WITH {_TX_SQL}
SELECT CAST(n AS BIGINT) AS n_transactions, round(s, 6) AS effective_support FROM nn""")
def q_effective_support(spark, sf):
    m = _mined(spark, sf)
    return spark.range(1).select(F.lit(m.n_transactions).cast("long").alias("n_transactions"),
                                 r6(F.lit(m.effective_support)).alias("effective_support"))


@register("frequent_itemsets", f"""WITH {_TX_SQL}
SELECT array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS size,
  CAST(freq AS BIGINT) AS freq, round(support, 6) AS support FROM sets""")
def q_frequent_itemsets(spark, sf):
    s = _mined(spark, sf).itemsets
    return s.select(F.array_join("items", "|").alias("items"), F.size("items").alias("size"),
                    "freq", r6("support").alias("support"))


def _rule_cols(df):
    return df.select(F.array_join("antecedents", "|").alias("antecedents"),
                     F.array_join("consequents", "|").alias("consequents"),
                     r6("support").alias("support"), r6("confidence").alias("confidence"),
                     r6("lift").alias("lift"))


@register("association_rules", f"""{_RULES_SQL}
SELECT {_RULE_COLS} FROM rules WHERE confidence >= {MIN_CONFIDENCE}""")
def q_association_rules(spark, sf):
    return _rule_cols(_mined(spark, sf).rules)


@register("top_rules", f"""{_RULES_SQL}
SELECT {_RULE_COLS} FROM rules WHERE confidence >= {MIN_CONFIDENCE}
ORDER BY lift DESC, array_to_string(ant, chr(1)), array_to_string(cons, chr(1)) LIMIT 10""")
def q_top_rules(spark, sf):
    return _rule_cols(top_rules(_mined(spark, sf).rules, 10))


# Transaction cleaning on real text: a document's words as its skill list.
# Its words include e-mail addresses, phone-like runs and domain names.
_WORDS_SQL = f"""
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (
  SELECT doc_id, CASE WHEN c = '' THEN []::VARCHAR[] ELSE string_split_regex(c, '{WS_RUN}') END AS words
  FROM (SELECT doc_id, {clean_text_sql('text')} AS c FROM documents)))"""


@register("clean_transactions", f"""WITH {_WORDS_SQL},
k AS (SELECT doc_id, {strip_ws_sql('word')} AS word, pos FROM w WHERE NOT {is_noise_skill_sql('word')}),
f AS (SELECT doc_id, word, pos FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, lower(word) ORDER BY pos) = 1)
SELECT doc_id, string_agg(word, '|' ORDER BY pos) AS items, CAST(count(*) AS BIGINT) AS n_items
FROM f GROUP BY doc_id""")
def q_clean_transactions(spark, sf):
    docs = documents(spark, sf).select(
        "doc_id", split_words(clean_text("text")).alias("words"))
    tx = transactions(docs, "words", "doc_id", clean=True)
    return tx.select(F.col("resume_id").alias("doc_id"), F.array_join("items", "|").alias("items"),
                     F.size("items").cast("long").alias("n_items"))


@register("dedupe_only", f"""WITH {_WORDS_SQL},
f AS (SELECT doc_id, word, pos FROM w QUALIFY row_number() OVER (PARTITION BY doc_id, word ORDER BY pos) = 1)
SELECT doc_id, string_agg(word, '|' ORDER BY pos) AS items, CAST(count(*) AS BIGINT) AS n_items
FROM f GROUP BY doc_id""")
def q_dedupe_only(spark, sf):
    docs = documents(spark, sf).select(
        "doc_id", split_words(clean_text("text")).alias("words"))
    tx = transactions(docs, "words", "doc_id", clean=False)
    return tx.select(F.col("resume_id").alias("doc_id"), F.array_join("items", "|").alias("items"),
                     F.size("items").cast("long").alias("n_items"))
