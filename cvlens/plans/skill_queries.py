"""Registered queries: skill candidates and normalisation.

Resumes are the labelled document resumes; the dictionary is the shipped one
plus rule-built entries from ``part`` (see ``sources.aliases.part_aliases``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cvlens.functions.fuzzy import similarity_sql
from cvlens.functions.sections import section_sql
from cvlens.functions.text import clean_text_sql, strip_ws_sql
from cvlens.operators.resumes import extract_skills
from cvlens.operators.skills import ITEM_SPLIT, exact_mapping, normalize_skills, skill_mapping
from cvlens.plans.registry import r6, register
from cvlens.session import stored
from cvlens.sources.aliases import part_aliases, part_aliases_sql
from cvlens.sources.tables import document_resumes, document_resumes_sql

CUTOFF = 85.0


def resume_skills(spark, sf):
    """(resume_id, category, explicit_skills, implicit_skills, skills) per document resume, and the aliases."""
    aliases = part_aliases(spark, sf)
    df = extract_skills(document_resumes(spark, sf), aliases)
    # stored, or filters on the lists would be pushed below the section search and repeat it
    return stored(df.select("resume_id", "category", "explicit_skills", "implicit_skills", "skills"), "skills"), aliases


def _distinct_in_order(col: str) -> str:
    return f"list_filter({col}, lambda x, i: NOT list_contains({col}[1:i-1], x))"


_TERMS_SQL = f"""terms AS (SELECT DISTINCT lower(trim(t)) AS term FROM (
    SELECT alias AS t FROM {part_aliases_sql()} UNION ALL SELECT canonical FROM {part_aliases_sql()})
  WHERE trim(t) <> ''),
pat AS (SELECT '(' || string_agg(
    CASE WHEN regexp_matches(term, '^[a-z0-9_]') THEN '\\b' ELSE '\\B' END || regexp_escape(term) ||
    CASE WHEN regexp_matches(term, '[a-z0-9_]$') THEN '\\b' ELSE '\\B' END, '|' ORDER BY length(term) DESC, term) || ')' AS p
  FROM terms)"""

_ITEM = ("lambda p: " + strip_ws_sql("regexp_replace(regexp_replace(" + strip_ws_sql("p")
                                     + r", '^[:\-. ]+', ''), '[. ]+\z', '')"))

SKILLS_SQL = f"""{_TERMS_SQL},
r AS (SELECT resume_id, category, {clean_text_sql('resume_str')} AS clean FROM {document_resumes_sql()}),
s AS (SELECT resume_id, category, {section_sql('clean', 'skills')} AS sk,
        {section_sql('clean', 'experience')} AS ex, {section_sql('clean', 'projects')} AS pr FROM r),
c AS (SELECT resume_id, category,
        list_filter(list_transform(string_split_regex(sk, '{ITEM_SPLIT}'), {_ITEM}), lambda s: length(s) > 1) AS ec,
        regexp_extract_all(lower(ex || chr(10) || pr), (SELECT p FROM pat), 1) AS ic FROM s),
k AS (SELECT resume_id, category, {_distinct_in_order('ec')} AS explicit_skills,
        {_distinct_in_order('ic')} AS implicit_skills FROM c)"""


@register("explicit_skills", f"""WITH {SKILLS_SQL}
SELECT resume_id, array_to_string(explicit_skills, '|') AS explicit_skills,
  CAST(len(explicit_skills) AS INTEGER) AS n_explicit FROM k""")
def q_explicit_skills(spark, sf):
    df, _ = resume_skills(spark, sf)
    return df.select("resume_id", F.array_join("explicit_skills", "|").alias("explicit_skills"),
                     F.size("explicit_skills").alias("n_explicit"))


@register("implicit_skills", f"""WITH {SKILLS_SQL}
SELECT resume_id, array_to_string(implicit_skills, '|') AS implicit_skills,
  CAST(len(implicit_skills) AS INTEGER) AS n_implicit FROM k""")
def q_implicit_skills(spark, sf):
    df, _ = resume_skills(spark, sf)
    return df.select("resume_id", F.array_join("implicit_skills", "|").alias("implicit_skills"),
                     F.size("implicit_skills").alias("n_implicit"))


@register("skill_set", f"""WITH {SKILLS_SQL}
SELECT resume_id, category, array_to_string(list_concat(explicit_skills, implicit_skills), '|') AS all_skills,
  CAST(len(explicit_skills) + len(implicit_skills) AS INTEGER) AS n_all FROM k""")
def q_skill_set(spark, sf):
    df, _ = resume_skills(spark, sf)
    return df.select("resume_id", "category", F.array_join("skills", "|").alias("all_skills"),
                     F.size("skills").alias("n_all"))


_UNIQ_SQL = f"""uniq AS (SELECT DISTINCT {strip_ws_sql('x')} AS skill FROM (
    SELECT unnest(list_concat(explicit_skills, implicit_skills)) AS x FROM k) WHERE {strip_ws_sql('x')} <> ''),
al AS (SELECT alias, min(canonical) AS exact FROM {part_aliases_sql()} GROUP BY alias),
ex AS (SELECT u.skill, al.exact FROM uniq u LEFT JOIN al ON lower(u.skill) = al.alias),
canon AS (SELECT DISTINCT canonical FROM {part_aliases_sql()}),
scored AS (SELECT e.skill, c.canonical, {similarity_sql('e.skill', 'c.canonical')} AS sim
  FROM ex e, canon c WHERE e.exact IS NULL),
best AS (SELECT skill, canonical, sim FROM scored WHERE sim >= {CUTOFF / 100.0}
  QUALIFY row_number() OVER (PARTITION BY skill ORDER BY sim DESC, canonical) = 1),
mapping AS (SELECT e.skill, coalesce(e.exact, b.canonical, lower(e.skill)) AS normalized,
  CASE WHEN e.exact IS NOT NULL THEN 'exact' WHEN b.canonical IS NOT NULL THEN 'fuzzy' ELSE 'fallback' END AS method,
  CASE WHEN e.exact IS NOT NULL THEN 100.0 ELSE b.sim * 100.0 END AS score
  FROM ex e LEFT JOIN best b ON e.skill = b.skill)"""


def _skills_long(spark, sf):
    df, aliases = resume_skills(spark, sf)
    return df.select(F.explode("skills").alias("skill")), aliases


@register("alias_exact", f"""WITH {SKILLS_SQL}, {_UNIQ_SQL}
SELECT skill, exact FROM ex""")
def q_alias_exact(spark, sf):
    return exact_mapping(*_skills_long(spark, sf)).select("skill", "exact")


@register("alias_fuzzy", f"""WITH {SKILLS_SQL}, {_UNIQ_SQL}
SELECT skill, normalized, round(score, 6) AS score FROM mapping WHERE method = 'fuzzy'""")
def q_alias_fuzzy(spark, sf):
    m = skill_mapping(*_skills_long(spark, sf), CUTOFF)
    return m.where(F.col("method") == "fuzzy").select("skill", "normalized", r6("score").alias("score"))


# Each resume has its own list and, under the same id, its explicit skills again: lists are normalised row by row.
@register("normalize_skills", f"""WITH {SKILLS_SQL}, {_UNIQ_SQL},
rows AS (SELECT resume_id, 0 AS part, list_concat(explicit_skills, implicit_skills) AS skills FROM k
         UNION ALL SELECT resume_id, 1, explicit_skills FROM k),
lg AS (SELECT resume_id, part, unnest(skills) AS raw, generate_subscripts(skills, 1) AS pos FROM rows),
mp AS (SELECT lg.resume_id, lg.part, lg.pos, coalesce(m.normalized, '') AS n FROM lg
       LEFT JOIN mapping m ON {strip_ws_sql('lg.raw')} = m.skill)
SELECT k.resume_id, CAST(k.part AS INTEGER) AS part, coalesce(x.normalized, '') AS normalized_skills,
  CAST(coalesce(x.cnt, 0) AS INTEGER) AS n_skills
FROM rows k LEFT JOIN (SELECT resume_id, part, string_agg(n, '|' ORDER BY pos) AS normalized, count(*) AS cnt
                       FROM mp GROUP BY resume_id, part) x ON k.resume_id = x.resume_id AND k.part = x.part""")
def q_normalize_skills(spark, sf):
    df, aliases = resume_skills(spark, sf)
    both = df.select("resume_id", F.explode(F.array(F.struct(F.lit(0).alias("part"), F.col("skills").alias("skills")),
                                                    F.struct(F.lit(1).alias("part"), F.col("explicit_skills").alias("skills")))).alias("r"))
    out = normalize_skills(both.select("resume_id", "r.part", "r.skills"), aliases, "skills", CUTOFF)
    return out.select("resume_id", "part", F.array_join("normalized_skills", "|").alias("normalized_skills"),
                      F.size("normalized_skills").alias("n_skills"))
