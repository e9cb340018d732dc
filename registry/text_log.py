from pyspark.sql import functions as F

from meterlens.functions.text import after_merge_phrase
from meterlens.plans import text_log
from meterlens.sources.usage_logs import base_table
from registry.base import oracle, plain_types, query, report


def _found(plan, **arguments):
    return query(
        lambda log: plan(log("query_history").select("query_id", "query_text"), "query_text",
                         **arguments)
    )


def _leading(log):
    texts = log("query_history").select(
        "query_id", after_merge_phrase(F.col("query_text")).alias("after_merge")
    )
    return text_log.leading_identifier(texts, "after_merge")


def _identifiers(plan):
    def run(spark, folder):
        wrapped = F.concat(F.lit("IDENTIFIER('"), "c_name", F.lit("')"))
        names = base_table(spark, folder, "customer").select(
            "c_custkey", wrapped.alias("column_name")
        )
        return plain_types(plan(names, "column_name"))

    return run


QUERIES = {
    "t01_table_references": _found(text_log.table_references),
    "t01_table_references_clean": _found(text_log.table_references, clean=True),
    "t01_scripts": report(text_log.table_references, "query_scripts", text_col="query_text"),
    "t01_scripts_clean": report(
        text_log.table_references, "query_scripts", text_col="query_text", clean=True
    ),
    "t01_table_reference_counts": report(
        text_log.table_reference_counts, "query_history", text_col="query_text"
    ),
    "t02_merge_target": _found(text_log.merge_target),
    "t03_merge_target_by_position": _found(text_log.merge_target_by_position),
    "t04_leading_identifier": query(_leading),
    "t05_identifier_argument": _identifiers(text_log.identifier_argument),
    "t06_identifier_call": _identifiers(text_log.identifier_call),
}

_ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _names(word: str) -> str:
    """The names behind each keyword as one list; ``word`` cuts a name out of ``x``."""
    return "list_concat(" + "list_concat(" * 2 + ", ".join(
        f"""list_filter(list_transform(string_split(upper(query_text), '{keyword}')[2:],
    lambda x: {word}),
    lambda x: contains(x, '.') or regexp_matches(x, '^[A-Z0-9]+$'))""" + closing
        for keyword, closing in (
            ("INSERT INTO", ""), ("COPY INTO", ")"), ("FROM", ")"), ("JOIN", ")")
        )
    )


_NAMES = _names(f"split_part(trim(x, {_ENDS}), ' ', 1)")
_CLEAN_NAMES = _names(f"rtrim(regexp_split_to_array(ltrim(x, {_ENDS}), '[ \\t\\n\\x0b\\f\\r]')[1], ';,)')")


def _listed(names: str, log: str = "query_history") -> str:
    return oracle(f"""
select query_id, query_text, nullif(array_to_string({names}, ', '), '') as table_names
from {log}""")


_AFTER = "ltrim(substr(upper(query_text), position('MERGE INTO' in upper(query_text)) + 10))"

ORACLES = {
    "t01_table_references": _listed(_NAMES),
    "t01_table_references_clean": _listed(_CLEAN_NAMES),
    "t01_scripts": _listed(_NAMES, "query_scripts"),
    "t01_scripts_clean": _listed(_CLEAN_NAMES, "query_scripts"),
    "t01_table_reference_counts": oracle(f"""
select table_name, count(*) as mentions
from (select unnest({_NAMES}) as table_name from query_history) n group by 1"""),
    "t02_merge_target": oracle(r"""
select query_id, query_text, nullif(regexp_extract(query_text,
  'MERGE\s+INTO\s+("[^"]+"|[A-Z0-9_\.]+)', 1, 'i'), '') as target_table
from query_history"""),
    "t03_merge_target_by_position": oracle(f"""
select query_id, query_text, case when position('MERGE INTO' in upper(query_text)) > 0 then
  substr({_AFTER}, 1, least(nullif(position(' ' in {_AFTER}), 0),
    nullif(position(chr(10) in {_AFTER}), 0), nullif(position(';' in {_AFTER}), 0), 100) - 1)
  end as target_table
from query_history"""),
    "t04_leading_identifier": oracle(rf"""
with merges as (
  select query_id, case when position('MERGE INTO' in upper(query_text)) > 0 then {_AFTER} end
    as after_merge from query_history)
select query_id, after_merge, nullif(regexp_extract(after_merge,
  '^("[^"]+"(\."[^"]+"){{0,2}}|[A-Z0-9_]+(\.[A-Z0-9_]+){{0,2}})', 0, 'i'), '') as target_table
from merges"""),
    "t05_identifier_argument": """
select c_custkey, 'IDENTIFIER(''' || c_name || ''')' as column_name, c_name as argument
from customer""",
    "t06_identifier_call": """
select c_custkey, 'IDENTIFIER(''' || c_name || ''')' as column_name,
  'IDENTIFIER(''' || c_name || ''')' as call from customer""",
}
