"""Business records made from the customers: one of source 1 each, and other spellings of some of them in sources 2 and 3. The SQL is plain enough for Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FIRST = "acme bright cedar delta ember falcon garnet harbor indigo jasper kestrel lotus marble nectar onyx pearl quartz raven summit timber"
_SECOND = "foods tools motors textiles traders metals plastics papers glass media travel homes farms books toys drinks lamps tyres paints games"
_CITY = {"US": "tyler austin denver mesa reno", "India": "pune thane nagpur surat kota", "France": "bordeaux lyon lille nantes dijon"}
_STATE = {"US": "tx az il nv oh", "India": "mh gj ka rj tg"}
_STATE_NAME = {"US": "Texas Arizona Illinois Nevada Ohio", "India": "Maharashtra Gujarat Karnataka Rajasthan Telangana"}
_ZIP = {"US": "75701 85001 62701 89501 43004", "India": "411001 380001 560001 302001 500001", "France": "33000 69001 59000 44000 21000"}
_STREET = {"US": "Biggs Rebecca Dayton Newton Cotten", "India": "Gandhi Nehru Tilak Bose Patel", "France": "Daurat Dimu Voltaire Hugo Zola"}
_TYPE = {"US": "Street Road Avenue Lane Drive", "India": "Road Marg Road Marg Road", "France": "Rue Rue Avenue Rue Chemin"}
_SUFFIX = {"US": "Inc", "India": "Private Limited", "France": "SARL"}


def _by_country(values: dict[str, str], n: str) -> str:
    """The n-th word of the country's list."""
    return "CASE country " + " ".join(f"WHEN '{c}' THEN split_part('{v}', ' ', CAST({n} AS INT))" for c, v in values.items()) + " ELSE '' END"


#: The parts from which names and addresses are put together; the parser must find them again.
PARTS_SQL = f"""
SELECT *, {_by_country(_CITY, "k % 5 + 1")} AS city, {_by_country(_STATE, "k % 5 + 1")} AS state, {_by_country(_STATE_NAME, "k % 5 + 1")} AS state_name, {_by_country(_ZIP, "k % 5 + 1")} AS zip,
  {_by_country(_STREET, "(k // 5) % 5 + 1")} AS street, {_by_country(_TYPE, "(k // 25) % 5 + 1")} AS kind, CASE country {' '.join(f"WHEN '{c}' THEN '{s}'" for c, s in _SUFFIX.items())} END AS suffix,
  split_part('{_FIRST}', ' ', CAST((k * 7) % 20 + 1 AS INT)) AS w1, split_part('{_SECOND}', ' ', CAST((k // 3) % 20 + 1 AS INT)) AS w2,
  CASE WHEN country = 'India' THEN CAST(k % 400 + 1 AS STRING) || '-' || CAST(k % 7 + 1 AS STRING) || '/b' ELSE CAST(k % 400 + 1 AS STRING) END AS num
FROM (SELECT c_custkey AS k, CASE c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS country FROM customer WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL) c"""

#: The records with the parts that the parser is to find: source 1 of every customer, source 2 of every second, source 3 of every third.
RECORDS_SQL = f"""
SELECT 'S1-' || CAST(k AS STRING) AS entity_id, w1 || ' ' || w2 || ' ' || suffix AS business_name,
  CASE country WHEN 'France' THEN num || ' ' || kind || ' ' || street || ', ' || zip || ' ' || upper(city) || ', Region'
    ELSE num || ' ' || street || ' ' || kind || ', ' || city || ', ' || state_name || ' ' || zip END AS business_address,
  country, num AS want_num, city AS want_city, state AS want_state, zip AS want_zip, substr(w1, 1, 1) || substr(w2, 1, 1) AS want_acronym FROM parts
UNION ALL
SELECT 'S2-' || CAST(k AS STRING), upper(w1) || '  ' || w2, CASE country WHEN 'France' THEN zip || ' ' || city || ', ' || num || ' ' || kind || ' ' || street ELSE upper(state) || ', ' || city || ', ' || num || ' ' || street || ' ' || kind END,
  country, num, city, state, CASE country WHEN 'France' THEN zip ELSE '' END, substr(w1, 1, 1) || substr(w2, 1, 1) FROM parts WHERE k % 2 = 0
UNION ALL
SELECT 'S3-' || CAST(k AS STRING), w2 || ' & ' || w1, CASE WHEN k % 5 = 0 THEN '' WHEN country = 'France' THEN num || ' ' || kind || ' ' || street || ', ' || city ELSE num || ' ' || street || ' ' || kind || ', null, ' || city || ', ' || state_name END,
  country, CASE WHEN k % 5 = 0 THEN '' ELSE num END, CASE WHEN k % 5 = 0 THEN '' ELSE city END, CASE WHEN k % 5 = 0 THEN '' ELSE state END, '', substr(w2, 1, 1) || 'a' || substr(w1, 1, 1) FROM parts WHERE k % 3 = 0"""

DUCK = f"parts AS ({PARTS_SQL}), party AS ({RECORDS_SQL})"


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country and the parts that went into them."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    parts = spark.sql(PARTS_SQL.replace("//", "div").replace("FROM customer", "FROM {customer}"), customer=customer)
    return spark.sql(RECORDS_SQL.replace("FROM parts", "FROM {parts}"), parts=parts)


def party_truth(records: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_id) of the spellings of one customer."""
    from pyspark.sql import functions as F

    key = F.substring("entity_id", 4, 20).alias("key")
    first = records.where("entity_id like 'S1-%'").select(key, F.col("entity_id").alias("source1_entity_id"))
    return first.join(records.where("entity_id not like 'S1-%'").select(key, F.col("entity_id").alias("candidate_entity_id")), "key").drop("key")
