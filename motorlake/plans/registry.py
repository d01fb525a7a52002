"""Registered queries and the SQL text each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from motorlake.plans import adapters

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- shared oracle tables
_seq = f"row({adapters.SEQ_COLUMNS})"
_digits = "regexp_extract(replace(p_text, ',', ''), '([0-9]+)', 1)"
_no_price = f"(p_text is null or contains(p_text, 'N/A') or {_digits} = '')"
_km_pattern = r"'(?i)([0-9,]+)\s*(km|miles|mi)'"

TABLES = {
    "rates": (
        "select 'USD' as currency, cast(1.0 as double) as per_usd union all "
        "select 'EUR', cast(0.93 as double) union all select 'AMD', cast(405.0 as double) "
        "union all select 'RUB', cast(91.5 as double)"
    ),
    "items": adapters.ITEMS.format(part="part"),
    "cars": adapters.CARS.format(orders="orders"),
    "tags_raw": adapters.TAGS.format(seq=_seq, lineitem="lineitem"),
    "tags": (
        "select car_id, attribute, value, seq from (select *, row_number() over "
        "(partition by car_id, attribute order by seq) as rn from tags_raw) where rn = 1"
    ),
    "firsts": (
        "select car_id, attribute, value from (select *, row_number() over "
        "(partition by car_id, attribute order by seq) as rn from tags_raw "
        "where value is not null) where rn = 1"
    ),
    "words": "select *, string_split(trim(split_part(l_text, ',', 1)), ' ') as w from items",
    "read": f"""
      select *,
        case when {_no_price} then cast(0 as double) else cast({_digits} as double) end as price_value,
        case when {_no_price} then 'USD' when contains(p_text, '֏') or contains(p_text, 'AMD') then 'AMD'
          when contains(p_text, '€') or contains(p_text, 'EUR') then 'EUR'
          when contains(p_text, '₽') or contains(p_text, 'RUB') then 'RUB' else 'USD' end as currency,
        coalesce(cast(trunc(try_cast(replace(regexp_extract(at_text, {_km_pattern}, 1), ',', '') as double)
          * case when contains(lower(regexp_extract(at_text, {_km_pattern}, 2)), 'mi')
            then cast(1.60934 as double) else cast(1 as double) end) as bigint), 0) as km,
        case when len(w) >= 2 and regexp_full_match(w[1], '[0-9]+') then cast(w[1] as int) else 0 end as year,
        case when len(w) >= 2 then w[2] else 'Other' end as make,
        case when len(w) >= 2 then array_to_string(w[3:], ' ') else l_text end as model,
        case when len(w) >= 2 then trim(split_part(l_text, ',', 2)) else '' end as spec,
        trim(split_part(at_text, ',', 1)) as location,
        case when contains(at_text, 'Gasoline') then 'Gasoline' when contains(at_text, 'Diesel') then 'Diesel'
          when contains(at_text, 'Hybrid') then 'Hybrid' when contains(at_text, 'Electric') then 'Electric'
          when contains(at_text, 'LPG') then 'LPG' when contains(at_text, 'CNG') then 'CNG' else 'Other' end as fuel
      from words
    """,
    "parsed": (
        "select read.*, price_value / rates.per_usd as usd from read "
        "join rates on rates.currency = read.currency"
    ),
}
_NEEDS = {
    "tags": ["tags_raw"],
    "firsts": ["tags_raw"],
    "words": ["items"],
    "read": ["words"],
    "parsed": ["read", "rates"],
}


def with_tables(names: str, body: str, **more: str) -> str:
    """``body`` behind the named shared tables, and any further ones given as SQL."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} as ({TABLES[n]})" for n in ordered] + [f"{n} as ({sql})" for n, sql in more.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` with its oracle."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from motorlake.plans import (  # noqa: F401
        extract_queries,
        index_queries,
        ingest_queries,
        model_queries,
        search_queries,
    )
