"""All linkage queries by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from tallyweave.functions.lexicon import LEGAL_SUFFIXES, STREET_TYPES, alternatives
from tallyweave.plans import linkage as p

QUERIES = {
    "ingest_profile": p.profile, "clean_text": p.cleaned, "street_canon": p.streets, "legal_suffix": p.suffixes, "exact_key_pairs": p.channel("exact_key"), "rare_token_pairs": p.channel("rare_token"),
    "tfidf_topk_name": p.channel("name_tfidf"), "candidate_union_cap": p.candidates, "context_features": p.contextual, "set_similarity_features": p.similarities, "stub_scores": p.scored,
    "unique_claims": p.claims, "prefix_decisions": p.decisions, "prefix_matches": p.matches, "id_lists": p.match_lists, "macro_f05": p.evaluated, "f05_breakdown": p.evaluation,
    "hard_negatives": p.negatives, "calibration_bins": p.calibration, "threshold_rule": p.thresholds, "cap_sweep": p.sweep, "edit_similarity": p.edits, "fold_accents": p.folds, "stratified_quota": p.stratified, "submission_violations": p.submission, "end_to_end_stub": p.end_to_end,
}

W = r"regexp_extract_all(coalesce(text, ''), '[^\s]+')"
CLEAN = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
LIST = "list_filter(string_split({}, ' '), lambda x: x <> '')"

REC = f"""rec AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, array_to_string({W}[1:6], ' ') AS business_name,
  array_to_string({W}[7:], ' ') AS business_address, coalesce(lang, '') AS country FROM documents),
n0 AS (SELECT entity_id, country, {CLEAN.format('business_name')} AS name_norm, {CLEAN.format('business_address')} AS addr_norm FROM rec),
n1 AS (SELECT *, {LIST.format('name_norm')} AS name_tokens, {LIST.format('addr_norm')} AS addr_tokens FROM n0),
norm AS (SELECT *, array_to_string(list_transform(name_tokens, lambda x: x[1:1]), '') AS name_acronym FROM n1)"""

EXACT = """ek AS (SELECT 0 AS family, country, entity_id, name_norm AS k1, '' AS k2 FROM norm WHERE name_norm <> ''
  UNION ALL SELECT 1, country, entity_id, name_acronym, addr_norm FROM norm WHERE name_acronym <> '' AND addr_norm <> ''),
ek1 AS (SELECT *, count(*) OVER (PARTITION BY family, country, k1, k2, entity_id LIKE 'S1-%') AS bucket FROM ek),
ek2 AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, count(DISTINCT a.family) AS families, min(b.bucket) AS bucket
  FROM ek1 a JOIN ek1 b USING (family, country, k1, k2) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' AND a.bucket <= 1000 AND b.bucket <= 1000 GROUP BY ALL),
exact AS (SELECT source1_entity_id, candidate_entity_id, least(row_number() OVER (PARTITION BY source1_entity_id ORDER BY families DESC, bucket, candidate_entity_id), 65535)::INTEGER AS channel_rank,
  families::DOUBLE AS channel_score FROM ek2)"""

RARE = """rt AS (SELECT DISTINCT country, entity_id, unnest(list_concat(list_transform(name_tokens, lambda x: 'n:' || x), list_transform(addr_tokens, lambda x: 'a:' || x))) AS token FROM norm),
rn AS (SELECT country, count(*) AS n FROM norm GROUP BY ALL),
rd AS (SELECT country, token, count(*) AS df FROM rt GROUP BY ALL),
rk AS (SELECT rd.country, token, df FROM rd JOIN rn USING (country) WHERE df >= 2 AND df <= least(floor(0.05::DOUBLE * n), 5000)),
rs AS (SELECT country, entity_id, token, df FROM rt JOIN rk USING (country, token) WHERE entity_id LIKE 'S1-%' QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY df, token) <= 3),
rp AS (SELECT s.entity_id AS source1_entity_id, t.entity_id AS candidate_entity_id, count(*)::DOUBLE AS channel_score, min(s.df) AS df FROM rs s JOIN rt t USING (country, token)
  WHERE t.entity_id NOT LIKE 'S1-%' GROUP BY ALL),
rare AS (SELECT source1_entity_id, candidate_entity_id, (row_number() OVER (PARTITION BY source1_entity_id ORDER BY channel_score DESC, df, candidate_entity_id))::INTEGER AS channel_rank, channel_score
  FROM rp QUALIFY channel_rank <= 100)"""

TFIDF = """tt AS (SELECT country, entity_id, ' ' || unnest(name_tokens) || ' ' AS t FROM norm),
tg AS (SELECT country, entity_id, substr(t, i::INTEGER, n::INTEGER) AS gram FROM (SELECT *, unnest(range(1, greatest(length(t) - n + 1, 1) + 1)) AS i FROM (SELECT *, unnest([3, 4]) AS n FROM tt))),
tf AS (SELECT country, entity_id, gram, count(*) AS tf FROM tg GROUP BY ALL),
tn AS (SELECT country, count(*) AS n FROM norm WHERE entity_id NOT LIKE 'S1-%' AND len(name_tokens) > 0 GROUP BY ALL),
td AS (SELECT tf.country, gram, count(*) AS df FROM tf WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL),
ti AS (SELECT td.country, gram, df, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf, df <= floor(0.01::DOUBLE * n) AS core FROM td JOIN tn USING (country) WHERE df >= 2),
tk AS (SELECT tf.country, entity_id, gram, core, (ln(tf) + 1) * idf AS w, bool_or(core) OVER (PARTITION BY tf.country, entity_id) AS has_core,
  row_number() OVER (PARTITION BY tf.country, entity_id ORDER BY core, df, gram) AS nth FROM tf JOIN ti USING (country, gram)),
tw0 AS (SELECT * FROM tk WHERE core OR (NOT has_core AND nth <= 5)),
tw AS (SELECT country, entity_id, gram, core, w / sqrt(sum(w * w) OVER (PARTITION BY country, entity_id)) AS w FROM tw0),
tp AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, round(sum(a.w * b.w), 8) AS channel_score FROM tw a JOIN tw b USING (country, gram, core)
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY ALL),
tfidf AS (SELECT source1_entity_id, candidate_entity_id, (row_number() OVER (PARTITION BY source1_entity_id ORDER BY channel_score DESC, candidate_entity_id))::INTEGER AS channel_rank, channel_score
  FROM tp QUALIFY channel_rank <= 5)"""

CANDS = f"""{REC}, {EXACT}, {RARE}, {TFIDF},
lng AS (SELECT source1_entity_id, candidate_entity_id, 1 AS bit, channel_rank FROM tfidf UNION ALL SELECT source1_entity_id, candidate_entity_id, 4, channel_rank FROM exact
  UNION ALL SELECT source1_entity_id, candidate_entity_id, 8, channel_rank FROM rare),
uni AS (SELECT source1_entity_id, candidate_entity_id, bit_or(bit) AS channels, count(*) AS n_channels, min(channel_rank) AS best_rank, round(sum(1.0::DOUBLE / channel_rank), 8) AS prior_score FROM lng GROUP BY ALL),
slots AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY prior_score DESC, n_channels DESC, best_rank, candidate_entity_id) AS slot FROM uni),
cands AS (SELECT * EXCLUDE (slot) FROM slots WHERE slot <= 30)"""

TRUTH = """who AS (SELECT doc_id, doc_id % 3 + 1 AS source, coalesce(lang, '') AS country, text FROM documents WHERE text IS NOT NULL),
firsts AS (SELECT country, text, source, min(doc_id) AS doc_id FROM who WHERE source > 1 GROUP BY ALL),
truth AS (SELECT 'S1-' || a.doc_id AS source1_entity_id, 'S' || b.source || '-' || b.doc_id AS candidate_entity_id FROM who a JOIN firsts b USING (country, text) WHERE a.source = 1)"""

STUB = """stub0 AS (SELECT *, min(prior_score) OVER (PARTITION BY source1_entity_id) AS lo, max(prior_score) OVER (PARTITION BY source1_entity_id) AS hi FROM cands),
stub AS (SELECT source1_entity_id, candidate_entity_id, CASE WHEN hi > lo THEN round((prior_score - lo) / (hi - lo), 8) ELSE 0.5 END AS prob FROM stub0)"""

EVENTS = """ev AS (SELECT 'S1-' || lpad(user_id::VARCHAR, 5, '0') AS source1_entity_id, 'S2-' || lpad((((floor(value)::BIGINT % 200) + 200) % 200)::VARCHAR, 5, '0') AS candidate_entity_id,
  max(round(value - floor(value), 6)) AS prob FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL)"""


def claim(source: str) -> str:
    return f"claims AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY candidate_entity_id ORDER BY prob DESC, source1_entity_id) = 1)"


PREFIX = """px AS (SELECT *, row_number() OVER o AS pos, sum(prob) OVER (o ROWS UNBOUNDED PRECEDING) AS c, sum(prob) OVER (PARTITION BY source1_entity_id) AS k FROM claims
  WINDOW o AS (PARTITION BY source1_entity_id ORDER BY prob DESC, candidate_entity_id)),
pe AS (SELECT *, round(1.25::DOUBLE * c / (0.25::DOUBLE * k + pos), 8) AS ef FROM px),
pb AS (SELECT source1_entity_id, max(ef) AS best_ef, round(product(1 - prob), 8) AS empty_ef FROM pe GROUP BY ALL),
pm AS (SELECT pe.source1_entity_id, min(pos) AS m FROM pe JOIN pb USING (source1_entity_id) WHERE ef = best_ef GROUP BY ALL),
pd AS (SELECT pe.*, best_ef, empty_ef, CASE WHEN empty_ef >= best_ef THEN 0 ELSE m END AS m_star FROM pe JOIN pb USING (source1_entity_id) JOIN pm USING (source1_entity_id))"""

EVAL = f"""{REC}, {EXACT}, {TRUTH},
tp_ AS (SELECT source1_entity_id, candidate_entity_id, 1 AS t, 0 AS p FROM truth UNION ALL SELECT source1_entity_id, candidate_entity_id, 0, 1 FROM exact),
tq AS (SELECT source1_entity_id, candidate_entity_id, max(t) AS t, max(p) AS p FROM tp_ GROUP BY ALL),
tc AS (SELECT source1_entity_id, sum(t)::BIGINT AS k, sum(p)::BIGINT AS m, sum(t * p)::BIGINT AS c, sum(t * p)::BIGINT AS k_in_cand FROM tq GROUP BY ALL),
e0 AS (SELECT entity_id AS source1_entity_id, country, coalesce(k, 0) AS k, coalesce(m, 0) AS m, coalesce(c, 0) AS c, coalesce(k_in_cand, 0) AS k_in_cand FROM norm LEFT JOIN tc ON entity_id = source1_entity_id WHERE entity_id LIKE 'S1-%'),
ent AS (SELECT *, round(CASE WHEN k = 0 THEN CASE WHEN m = 0 THEN 1.0 ELSE 0.0 END WHEN m = 0 THEN 0.0 ELSE 1.25::DOUBLE * c / (0.25::DOUBLE * k + m) END, 8)::DOUBLE AS f05 FROM e0)"""

LABELLED = f"{EVENTS}, lab AS (SELECT *, CASE WHEN substr(candidate_entity_id, 4, 5)::INTEGER % 3 = 0 THEN 1 ELSE 0 END AS label FROM ev)"
GRAM = "list_distinct(list_transform(range(1, length({0}) - 1), lambda i: substr({0}, i, 3)))"
STREET_LIST = "[" + ", ".join(f"'{w}'" for w in STREET_TYPES) + "]"
STREET_CASE = "CASE x " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STREET_TYPES.items()) + " ELSE x END"

TRAIL = {c: f"(?:^|\\s)((?:{alternatives(w)})(?:\\s(?:{alternatives(w)}))*)$" for c, w in LEGAL_SUFFIXES.items()}
LEAD = f"^((?:{alternatives(LEGAL_SUFFIXES['France'])})(?:\\s(?:{alternatives(LEGAL_SUFFIXES['France'])}))*)(?:\\s|$)"
BY_COUNTRY = "CASE country " + " ".join(f"WHEN '{c}' THEN {{}}".format(f"regexp_{{0}}(name, '{t}', {{1}})") for c, t in TRAIL.items()) + " END"
SUFFIX_SQL = f"""WITH a AS (SELECT c_custkey, (['US', 'India', 'France'])[(c_custkey % 3 + 1)::INTEGER] AS country, trim((['', '', 'sarl ', '', '', 'sas ', ''])[(c_custkey % 7 + 1)::INTEGER] || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE lower(c_mktsegment) END
        || ' ' || (['private limited', 'inc', 'sarl', '', 'and co', 'l l c', 'pvt ltd', 'sas'])[(c_custkey % 8 + 1)::INTEGER]) AS name FROM customer),
      b AS (SELECT *, {BY_COUNTRY.replace('{0}', 'replace').replace('{1}', "''")} AS rest, {BY_COUNTRY.replace('{0}', 'extract').replace('{1}', '1')} AS gone FROM a),
      c AS (SELECT c_custkey, name, CASE WHEN country = 'France' THEN trim(regexp_extract(rest, '{LEAD}', 1) || ' ' || gone) ELSE gone END AS gone, trim(CASE WHEN country = 'France' THEN regexp_replace(rest, '{LEAD}', '') ELSE rest END) AS rest FROM b)
      SELECT c_custkey, CASE WHEN rest = '' THEN name ELSE rest END AS stripped, CASE WHEN rest = '' THEN '' ELSE gone END AS removed FROM c"""

ORACLES = {
    "ingest_profile": f"WITH {REC} SELECT country, count(*) AS n, count(DISTINCT entity_id) AS ids, count_if(business_address = '') AS no_address, count(DISTINCT business_name) AS names FROM rec GROUP BY ALL",
    "clean_text": rf"""WITH {REC} SELECT entity_id, name_norm, addr_norm, name_acronym,
      replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(name_norm, 'a{{2,}}', 'a', 'g'), 'e{{2,}}', 'e', 'g'), 'i{{2,}}', 'i', 'g'), 'o{{2,}}', 'o', 'g'), 'u{{2,}}', 'u', 'g'), 'ph', 'f') AS name_fold,
      CASE WHEN regexp_matches(name_norm, '\p{{L}}') THEN 1 ELSE 0 END AS script FROM norm""",
    "street_canon": f"""SELECT c_custkey, array_to_string(list_transform(string_split(c_custkey || ' north ' || lower(c_mktsegment) || ' ' || ({STREET_LIST})[(c_custkey % {len(STREET_TYPES)} + 1)::INTEGER] || ' pobox 7', ' '),
      lambda x: {STREET_CASE}), ' ') AS street FROM customer""",
    "legal_suffix": SUFFIX_SQL,
    "exact_key_pairs": f"WITH {REC}, {EXACT} SELECT * FROM exact",
    "rare_token_pairs": f"WITH {REC}, {RARE} SELECT * FROM rare",
    "tfidf_topk_name": f"WITH {REC}, {TFIDF} SELECT * FROM tfidf",
    "candidate_union_cap": f"WITH {CANDS} SELECT * FROM cands",
    "context_features": f"""WITH {CANDS} SELECT *, max(prior_score) OVER e AS entity_best, count(*) OVER e AS entity_n_cands, max(prior_score) OVER r AS cand_best_score, count(*) OVER r AS cand_n_claims,
      round(max(prior_score) OVER e - prior_score, 8) AS margin_to_best, round(1.0::DOUBLE / best_rank, 8) AS reciprocal_rank, CASE WHEN candidate_entity_id LIKE 'S3-%' THEN 1 ELSE 0 END AS is_source3,
      CASE WHEN prior_score >= max(prior_score) OVER r - 1e-7 THEN 1 ELSE 0 END AS cand_is_argmax FROM cands WINDOW e AS (PARTITION BY source1_entity_id), r AS (PARTITION BY candidate_entity_id)""",
    "set_similarity_features": f"""WITH {REC}, {EXACT}, {RARE}, pr AS (SELECT source1_entity_id, candidate_entity_id FROM exact UNION SELECT source1_entity_id, candidate_entity_id FROM rare),
      s AS (SELECT pr.*, a.name_norm AS a, b.name_norm AS b, list_distinct(a.name_tokens) AS x, list_distinct(b.name_tokens) AS y, {GRAM.format('a.name_norm')} AS g, {GRAM.format('b.name_norm')} AS h
        FROM pr JOIN norm a ON a.entity_id = source1_entity_id JOIN norm b ON b.entity_id = candidate_entity_id),
      i AS (SELECT *, len(list_intersect(x, y)) AS xy, len(list_intersect(g, h)) AS gh, least(length(a), length(b)) AS lo, greatest(length(a), length(b)) AS hi FROM s)
      SELECT source1_entity_id, candidate_entity_id, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE round(xy::DOUBLE / (len(x) + len(y) - xy), 8) END::DOUBLE AS token_jaccard,
        CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE round(xy::DOUBLE / least(len(x), len(y)), 8) END::DOUBLE AS token_containment,
        CASE WHEN len(g) = 0 OR len(h) = 0 THEN 0.0 ELSE round(gh::DOUBLE / (len(g) + len(h) - gh), 8) END::DOUBLE AS char3_jaccard,
        CASE WHEN lo = 0 THEN 0.0 ELSE round(len(list_filter(range(1, lo + 1), lambda q: substr(a, 1, q) = substr(b, 1, q)))::DOUBLE / hi, 8) END::DOUBLE AS prefix_ratio,
        CASE WHEN lo = 0 THEN 0.0 ELSE round(lo::DOUBLE / hi, 8) END::DOUBLE AS length_ratio FROM i""",
    "stub_scores": f"WITH {CANDS}, {STUB} SELECT * FROM stub",
    "unique_claims": f"WITH {EVENTS}, {claim('ev')} SELECT * FROM claims",
    "prefix_decisions": f"WITH {EVENTS}, {claim('ev')}, {PREFIX} SELECT DISTINCT source1_entity_id, round(k, 6) AS k_hat, empty_ef, best_ef, m_star FROM pd",
    "prefix_matches": f"WITH {EVENTS}, {claim('ev')}, {PREFIX} SELECT source1_entity_id, candidate_entity_id FROM pd WHERE pos <= m_star",
    "id_lists": f"""WITH {EVENTS}, {claim('ev')}, {PREFIX}, l AS (SELECT source1_entity_id, string_agg(candidate_entity_id, ',' ORDER BY pos) AS ids FROM pd WHERE pos <= m_star GROUP BY ALL)
      SELECT source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM (SELECT DISTINCT source1_entity_id FROM ev) LEFT JOIN l USING (source1_entity_id)""",
    "macro_f05": f"WITH {EVAL} SELECT * FROM ent",
    "f05_breakdown": f"""WITH {EVAL}, b AS (SELECT *, CASE WHEN k <= 0 THEN '0' WHEN k <= 1 THEN '1' WHEN k <= 3 THEN '2-3' WHEN k <= 5 THEN '4-5' ELSE '6+' END AS k_bucket FROM ent)
      SELECT country, k_bucket, count(*) AS entities, round(avg(f05), 6) AS macro_f05, round(sum(c)::DOUBLE / nullif(sum(m), 0), 6) AS "precision", round(sum(c)::DOUBLE / nullif(sum(k), 0), 6) AS recall,
      round(sum(k_in_cand)::DOUBLE / nullif(sum(k), 0), 6) AS blocking_recall, round(avg(m), 6) AS mean_predicted, round(count_if(k = 0 AND m = 0)::DOUBLE / nullif(count_if(k = 0), 0), 6) AS singleton_accuracy
      FROM b GROUP BY GROUPING SETS ((), (country), (k_bucket))""",
    "hard_negatives": f"""WITH {LABELLED}, h AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, label ORDER BY prob DESC, candidate_entity_id) AS nth, sum(label) OVER (PARTITION BY source1_entity_id) AS n_pos FROM lab)
      SELECT source1_entity_id, candidate_entity_id, label FROM h WHERE label = 1 OR nth <= greatest(ceil(2.0 * n_pos), 3)""",
    "calibration_bins": f"""WITH {LABELLED} SELECT least(floor(prob * 10), 9)::INTEGER AS tenth, count(*) AS n, round(avg(prob), 6) AS mean_prob, round(avg(label), 6) AS rate,
      round(avg((prob - label) * (prob - label)), 6) AS brier FROM lab GROUP BY ALL""",
    "threshold_rule": f"""WITH {EVENTS} SELECT source1_entity_id, candidate_entity_id, prob FROM ev
      QUALIFY prob >= 0.6::DOUBLE AND row_number() OVER (PARTITION BY source1_entity_id ORDER BY prob DESC, candidate_entity_id) <= 5 AND prob >= max(prob) OVER (PARTITION BY source1_entity_id) - 0.2::DOUBLE""",
    "cap_sweep": f"""WITH {CANDS}, {TRUTH}, s2 AS (SELECT c.*, row_number() OVER (PARTITION BY c.source1_entity_id ORDER BY prior_score DESC, n_channels DESC, best_rank, c.candidate_entity_id) AS sl, t.source1_entity_id IS NOT NULL AS label
      FROM cands c LEFT JOIN truth t ON t.source1_entity_id = c.source1_entity_id AND t.candidate_entity_id = c.candidate_entity_id)
      SELECT cap, count_if(sl <= cap) AS pairs, count_if(sl <= cap AND label) AS found FROM s2, (SELECT unnest([1, 2, 3, 5, 10, 30]) AS cap) GROUP BY cap""",
    "edit_similarity": "SELECT p_partkey, round(jaro_winkler_similarity(lower(p_name), lower(p_type)), 6) AS jaro_winkler FROM part",
    "fold_accents": f"WITH {REC} SELECT entity_id, strip_accents(replace(replace(replace(business_name, 'œ', 'oe'), 'æ', 'ae'), 'ß', 'ss')) AS name_ascii FROM rec",
    "stratified_quota": f"""WITH {REC}, c AS (SELECT country, count(*) AS n FROM norm WHERE entity_id LIKE 'S1-%' GROUP BY ALL), t AS (SELECT *, sum(n) OVER () AS a FROM c),
      b AS (SELECT *, (100 * n // a)::BIGINT AS base, (100 * n) % a AS r FROM t), q AS (SELECT *, 100 - sum(base) OVER () AS rest, row_number() OVER (ORDER BY r DESC, country) AS nth FROM b)
      SELECT country, n, CASE WHEN a <= 100 THEN n ELSE base + CASE WHEN nth <= rest THEN 1 ELSE 0 END END::BIGINT AS quota FROM q""",
    "submission_violations": f"""WITH {REC}, {EXACT}, {TFIDF}, m AS (SELECT source1_entity_id, candidate_entity_id FROM exact)
      SELECT 'unknown query id' AS rule, * FROM m WHERE source1_entity_id NOT IN (SELECT entity_id FROM norm WHERE entity_id LIKE 'S1-%' AND country <> 'es')
      UNION ALL SELECT 'unknown pool id', * FROM m WHERE candidate_entity_id NOT IN (SELECT entity_id FROM norm WHERE entity_id NOT LIKE 'S1-%' AND country <> 'fr')
      UNION ALL SELECT 'no candidate', m.* FROM m ANTI JOIN tfidf USING (source1_entity_id, candidate_entity_id)
      UNION ALL SELECT 'matched twice', * FROM m WHERE candidate_entity_id IN (SELECT candidate_entity_id FROM m GROUP BY 1 HAVING count(*) > 1)""",
    "end_to_end_stub": f"WITH {CANDS}, {STUB}, {claim('stub')}, {PREFIX} SELECT source1_entity_id, candidate_entity_id, round(prob, 6) AS prob FROM pd WHERE pos <= m_star",
}
