"""The registered queries once more as plain SQL over the test tables, for another engine to check against."""

from __future__ import annotations

from tillhouse.registry.xx_sql import Projections

_SALE = """p.p_type as Category, p.p_brand as Sub_Category, p.p_name as Product_Name,
 cast(l.l_extendedprice as decimal(18,4)) as Sales, cast(l.l_quantity as int) as Quantity,
 cast(l.l_discount as decimal(18,4)) as Discount, cast(l.l_tax as decimal(18,4)) as Profit,
 cast(p.p_retailprice as decimal(18,4)) as Cost, l.l_orderkey * 10 + l.l_linenumber as payment_id,
 o.o_orderpriority as payment_method, o.o_orderstatus as payment_provider"""

ONLINE = f"""select l.l_orderkey as Order_ID, o.o_orderdate as Order_Date, {_SALE},
 c.c_mktsegment as customer_name, c.c_name as customer_surname,
 case when c.c_custkey % 2 = 0 then 'F' else 'M' end as customer_gender, cast(18 + c.c_custkey % 60 as int) as customer_age,
 ' ' || c.c_name || '@example.com ' as customer_email, '+1-' || cast(c.c_custkey as varchar(20)) as customer_phone_number,
 'Z' || cast(c.c_nationkey as varchar(20)) as Postal_Code,
 n.n_name || '-C' || cast(c.c_custkey % 3 as varchar(20)) || ' ' as City, n.n_name as State,
 'Q' || cast(n.n_nationkey % 4 as varchar(20)) as Region,
 case r.r_name when 'AMERICA' then ' USA ' when 'EUROPE' then 'UK' else r.r_name end as Country
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
 join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
 join part p on l.l_partkey = p.p_partkey
where l.l_orderkey % 2 = 0"""

OFFLINE = f"""select l.l_orderkey as Order_ID, o.o_orderdate as Order_date, {_SALE},
 s.s_suppkey as store_id, s.s_name as store_name, n.n_name || '-C' || cast(s.s_suppkey % 3 as varchar(20)) as store_city,
 n.n_name as store_state, 'Q' || cast(n.n_nationkey % 4 as varchar(20)) as store_region,
 case r.r_name when 'AMERICA' then 'United States' when 'EUROPE' then 'United Kingdom' else r.r_name end as store_country,
 s.s_suppkey % 37 as employee_id, 'E' || cast(s.s_suppkey % 37 as varchar(20)) as employee_name,
 'S' || cast(s.s_suppkey % 37 as varchar(20)) as employee_surname,
 case when s.s_suppkey % 37 % 2 = 0 then 'F' else 'M' end as employee_gender,
 cast(s.s_acctbal as decimal(10,2)) as employee_monthly_salary
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
 join (select *, count(*) over () as n_stores from supplier) s
  on s.s_suppkey = cast(floor(o.o_orderkey / 2) as bigint) % s.n_stores
 join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
 join part p on l.l_partkey = p.p_partkey
where l.l_orderkey % 2 = 1"""

_SHARED = """cast(Order_ID as varchar) as order_src_id_raw, Category as category_name, Sub_Category as sub_category_name,
 Product_Name as product_name, Sales as sales, Quantity as quantity, Discount as discount, Profit as profit, Cost as cost,
 cast(payment_id as varchar) as payment_id_raw, payment_method, payment_provider"""

_RAW = f"""select 'online' as source_system, 'online_bronze' as source_entity, {_SHARED}, Order_Date as order_date,
 Country as country_name, Region as region_name, State as state_name, City as city_name, trim(customer_email) as email,
 customer_name as first_name, customer_surname as last_name, customer_gender as gender, customer_age as age,
 customer_phone_number as phone_number, Postal_Code as postal_code, null::bigint as store_src_id, null::varchar as store_name,
 null::varchar as employee_src_id, null::varchar as employee_first_name, null::varchar as employee_last_name,
 null::varchar as employee_gender, null::decimal(10,2) as monthly_salary from online
union all
select 'offline', 'offline_bronze', {_SHARED}, Order_date, store_country, store_region, store_state, store_city, null, null,
 null, null, null, null, null, store_id, store_name, cast(employee_id as varchar), employee_name, employee_surname,
 employee_gender, employee_monthly_salary from offline"""

_CLEAN = """select * replace (trim(city_name) as city_name, trim(state_name) as state_name, trim(region_name) as region_name,
 case trim(country_name) when 'USA' then 'United States' when 'UK' then 'United Kingdom' else trim(country_name) end
 as country_name), md5(source_system || order_src_id_raw) as order_src_id from raw_lines"""

PRODUCT = ("category_name", "sub_category_name", "product_name")
CITY = ("country_name", "region_name", "state_name", "city_name")
STORE = ("store_src_id", "store_name", *CITY)
METHOD = ("payment_method", "payment_provider")


def _with(tables: dict[str, str], body: str, once: tuple[str, ...] = ()) -> str:
    """``once`` names tables that are built one time, which keeps the other engine's plan simple."""
    ctes = {"online": ONLINE, "offline": OFFLINE, "raw_lines": _RAW, "lines": _CLEAN, **tables}
    return "with " + ",\n".join(f"{n} as {'materialized ' if n in once else ''}({q})" for n, q in ctes.items()) + "\n" + body


def _sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), chr(30))" for c in cols)
    return f"(('0x' || substr(md5(concat_ws(chr(31), {parts})), 1, 15))::bigint)"


def _fk(*cols: str, required: int = 1) -> str:
    present = " and ".join(f"{c} is not null" for c in cols[-required:])
    return f"case when {present} then {_sk(*cols)} end"


def _label(column: str = "source_system") -> str:
    return f"case when count(distinct {column}) = 2 then 'online and offline' else min({column}) end as source_system"


def _dictionary(keys: tuple[str, ...], source: str = "lines") -> str:
    names = ", ".join(keys)
    return f"select {names}, {_label()} from {source} group by {names}"


def _level(name: str, path: tuple[str, ...], parent: str | None = None, hashed: str | None = None, extra: str = "") -> str:
    up = f"{_fk(*path[:-1])} as {parent}_id, " if parent else ""
    return (
        f"select {_sk(*path)} as {name}_id, {up}{extra}{name}_name, md5({hashed or name + '_name'}) as {name}_src_id, "
        f"source_system from ({_dictionary(path)})"
    )


CATEGORY = _level("category", PRODUCT[:1])
SUB_CATEGORY = _level("sub_category", PRODUCT[:2], "category")
PRODUCTS = _level("product", PRODUCT, "sub_category", extra="sub_category_name, ")
COUNTRY = _level("country", CITY[:1])
REGION = _level("region", CITY[:2], "country")
STATE = _level("state", CITY[:3], "region")
CITIES = _level("city", CITY, "state", hashed="city_name || state_name")
METHODS = f"select {_sk(*METHOD)} as method_id, * from ({_dictionary(METHOD)})"
STORES = (
    f"select {_sk(*STORE)} as store_id, {_fk(*CITY, required=2)} as city_id, store_name, store_src_id, "
    f"'offline' as source_system from (select distinct {', '.join(STORE)} from lines where source_system = 'offline')"
)
_CUSTOMER_ROWS = """select * from lines where source_system = 'online' qualify row_number() over (partition by email
 order by order_date desc, first_name desc, last_name desc, gender desc, age desc, phone_number desc, postal_code desc,
 country_name desc, region_name desc, state_name desc, city_name desc) = 1"""
CUSTOMERS = (
    f"select {_sk('email')} as customer_id, {_fk(*CITY, required=2)} as city_id, first_name, last_name, gender, age, email, "
    f"phone_number, postal_code, md5(email) as customer_src_id, 'online' as source_system from ({_CUSTOMER_ROWS})"
)

_CHANGES = """select employee_src_id, employee_first_name as first_name, employee_last_name as last_name,
 employee_gender as gender, monthly_salary, store_src_id, order_date as update_dt from lines where source_system = 'offline'"""


def _versions(changes: str, key: str, sequence: str, tracked: list[str]) -> str:
    desc = ", ".join(f"{c} desc" for c in tracked)
    differs = " or ".join(f"{c} is distinct from lag({c}) over w" for c in tracked)
    return f"""select {key}, {', '.join(tracked)}, {sequence} as start_at,
 lead({sequence}) over (partition by {key} order by {sequence}) as end_at from (
 select *, lag({sequence}) over w is null or {differs} as kept from (
  select * from ({changes}) where {key} is not null and {sequence} is not null
  qualify row_number() over (partition by {key}, {sequence} order by {desc}) = 1)
 window w as (partition by {key} order by {sequence})) where kept"""


EMPLOYEES = _versions(
    _CHANGES, "employee_src_id", "update_dt", ["store_src_id", "monthly_salary", "first_name", "last_name", "gender"]
)
EMPLOYEE_HISTORY = f"""select employee_src_id, first_name, last_name, gender, monthly_salary,
 cast(store_src_id as varchar) as store_src_id, start_at as update_dt, null::timestamp as insert_dt,
 start_at as __START_AT, end_at as __END_AT from ({EMPLOYEES})"""
DIM_EMPLOYEE = f"""select {_sk('employee_src_id', 'start_at')} as employee_sk, employee_src_id, first_name, last_name, gender,
 monthly_salary, cast(store_src_id as varchar) as store_src_id, start_at, end_at, end_at is null as is_current,
 'offline' as source_system from ({EMPLOYEES})"""
EVENTS_HISTORY = _versions("select user_id, ts, event_type from events", "user_id", "ts", ["event_type"])

_HEADER_ROWS = """select * from lines qualify row_number() over (partition by source_system, order_src_id_raw order by
 order_date, email, store_src_id, store_name, country_name, region_name, state_name, city_name, employee_src_id) = 1"""


def _order_id(relation: str, name: str = "order_id") -> str:
    chain = Projections(relation)
    chain.digest_text("order_src_id")
    chain.short_text("source_system")
    return chain.done(name)


def _item_id(relation: str) -> str:
    chain = Projections(relation)
    chain.digest_text("order_src_id")
    chain.short_text("product_name")
    chain.long_number("cast(sales * 10000 as bigint)")
    chain.int_number("quantity")
    return chain.done("order_item_id")


def _payment_id(relation: str) -> str:
    chain = Projections(relation)
    chain.digest_text("payment_src_id")
    chain.digest_text("order_src_id")
    return chain.done("payment_id")


ORDERS = f"""select order_id, case when source_system = 'online' then {_fk('email')} end as customer_id,
 case when source_system = 'offline' and store_src_id is not null then {_sk(*STORE)} end as store_id, employee_src_id,
 order_date, order_src_id, source_system, source_entity from ({_order_id(f'({_HEADER_ROWS})')})"""
_ITEM_ROWS = _item_id(f"({_order_id('lines')})")
ITEMS = f"""select order_item_id, order_id, {_fk(*PRODUCT)} as product_id, sales, quantity, discount, profit, cost
 from ({_ITEM_ROWS})"""
_PAID_LINES = "(select *, md5(source_system || payment_id_raw) as payment_src_id from lines)"
PAYMENT = f"""select payment_id, order_id, {_fk(*METHOD, required=2)} as method_id, payment_src_id, sales as payment_amount,
 source_system from ({_payment_id(f"({_order_id(_PAID_LINES)})")})"""
PER_ORDER = """select order_id, method_id, payment_amount from payment where order_id is not null
 qualify row_number() over (partition by order_id order by payment_id, payment_amount, method_id) = 1"""

FLAT_PLACES = f"select {_sk(*CITY)} as city_id, city_name, state_name, region_name, country_name from ({_dictionary(CITY)})"
DIM_PRODUCT = f"""select {_sk(*PRODUCT)} as product_sk, {_sk(*PRODUCT)} as product_id, md5(product_name) as product_src_id,
 product_name, sub_category_name, category_name, source_system from ({_dictionary(PRODUCT)})"""
DIM_CUSTOMER = """select customer_id as customer_sk, c.*, city_name, state_name, region_name, country_name
 from (select * exclude (city_id), city_id as _city from customers) c left join places on _city = places.city_id"""
DIM_CUSTOMER = f"select * exclude (_city) from ({DIM_CUSTOMER})"
DIM_STORE = """select store_id as store_sk, store_id, store_src_id, store_name, city_name, state_name, region_name,
 country_name, source_system from stores left join places on stores.city_id = places.city_id"""
DIM_DATE = """select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as full_date, cast(day(d) as int) as day,
 cast(month(d) as int) as month, cast(quarter(d) as int) as quarter, cast(year(d) as int) as year,
 strftime(d, '%A') as day_of_week, dayofweek(d) in (0, 6) as is_weekend
 from (select cast(unnest(generate_series(min(order_date)::date, max(order_date)::date, interval 1 day)) as date) as d from lines)"""

FACT = f"""select md5(o.order_src_id || cast(i.product_id as varchar)) as sale_sk, o.order_src_id as order_id, i.order_item_id,
 o.customer_id as customer_sk, e.employee_sk, o.store_id as store_sk, i.product_id as product_sk,
 p.method_id as payment_method_sk, cast(strftime(o.order_date, '%Y%m%d') as int) as order_date_sk, i.sales, i.quantity,
 i.discount, i.profit, i.cost, p.payment_amount, o.source_system, o.source_entity
 from items i left join orders_t o on i.order_id = o.order_id left join per_order p on i.order_id = p.order_id
 left join (select employee_sk, employee_src_id from ({DIM_EMPLOYEE}) where is_current) e
 on o.employee_src_id = e.employee_src_id"""
_FACT_TABLES = {"items": ITEMS, "orders_t": ORDERS, "payment": PAYMENT, "per_order": PER_ORDER}


def _leaf_levels() -> str:
    """The literal hierarchies: raw values except where the rules clean, parents joined by their own name."""
    usa = "case trim(country_name) when 'USA' then 'United States' else trim(country_name) end"
    steps = {
        "lf_category": ("category", _dictionary(("category_name",), "raw_lines"), None),
        "lf_sub_category": ("sub_category", _dictionary(("category_name", "sub_category_name"), "raw_lines"), "category"),
        "lf_product": ("product", _dictionary(("sub_category_name", "product_name"), "raw_lines"), "sub_category"),
        "lf_country": ("country", _dictionary(("country_name",), "lines"), None),
        "lf_region": (
            "region",
            _dictionary(
                ("country_name", "region_name"), f"(select * replace ({usa} as country_name) from raw_lines)"
            ),
            "country",
        ),
        "lf_state": ("state", _dictionary(("region_name", "state_name"), "raw_lines"), "region"),
        "lf_city": (
            "city",
            _dictionary(
                ("state_name", "city_name"),
                "(select * replace (trim(city_name) as city_name, trim(state_name) as state_name) from raw_lines)",
            ),
            "state",
        ),
    }
    ctes, parts = {}, []
    for cte, (name, rows, parent) in steps.items():
        if parent is None:
            ctes[cte] = f"select {_sk(name + '_name')} as {name}_id, {name}_name from ({rows})"
            continue
        ctes[cte] = (
            f"select {_sk(f'{parent}_name', f'{name}_name', f'{parent}_id')} as {name}_id, {parent}_id, {name}_name, "
            f"r.source_system from ({rows}) r left join lf_{parent} using ({parent}_name)"
        )
        parts.append(
            f"select '{name}' as level, {name}_id as id, cast({parent}_id as varchar) as parent_id, "
            f"{name}_name as name, source_system from {cte}"
        )
    return _with(ctes, " union all ".join(parts))


def _coverage() -> str:
    levels = {"country": CITY[:1], "region": CITY[:2], "state": CITY[:3], "city": CITY}
    levels |= {"category": PRODUCT[:1], "sub_category": PRODUCT[:2], "product": PRODUCT}
    parts = [
        f"select source_system, count(*) as n, '{name}' as dictionary from ({_dictionary(path)}) group by source_system"
        for name, path in levels.items()
    ]
    return _with({}, " union all ".join(parts))


def _text_keys(rows: str, *names: str) -> str:
    casts = ", ".join(f"cast({name} as varchar) as {name}" for name in names)
    return f"select * replace ({casts}) from ({rows})"


_ORDER_KEYS = ("customer_id", "store_id")
_FACT_KEYS = ("customer_sk", "employee_sk", "store_sk")


def _refresh() -> str:
    sizes = {"orders": f"({_HEADER_ROWS})", "orders_items": "lines", "payment": "lines", "employee_history": f"({EMPLOYEES})"}
    parts = [
        f"select '{name}' as table_name, count(*) as n_full, 0::bigint as n_different from {rows}"
        for name, rows in sizes.items()
    ]
    return _with({}, " union all ".join(parts))


def _refresh_star() -> str:
    sizes = {
        "categories": CATEGORY, "sub_categories": SUB_CATEGORY, "products": PRODUCTS, "country": COUNTRY, "region": REGION,
        "state": STATE, "city": CITIES, "store": STORES, "customer": CUSTOMERS, "payment_methods": METHODS,
        "dim_customer": CUSTOMERS, "dim_employee": EMPLOYEES, "dim_store": STORES, "dim_product": PRODUCTS,
        "dim_payment_method": METHODS, "fact_sales": "select * from lines",
    }
    parts = [f"select '{n}' as table_name, count(*) as n_full, 0::bigint as n_different from ({q})" for n, q in sizes.items()]
    # the online dates of this query are moved by up to two days; an order has the date of its earliest line
    moved = "order_date - to_days(case when source_system = 'online' then cast(payment_id_raw as bigint) % 3 else 0 end::int)"
    heads = f"(select min({moved}) as d from lines group by source_system, order_src_id_raw)"
    parts.append(f"select 'dim_date', max(d)::date - min(d)::date + 1, 0 from {heads}")
    return _with({}, " union all ".join(parts), once=("lines",))


def _late() -> str:
    """Three batches of events, each judged under the watermark of those before it."""
    steps = {
        "bounds": "select min(ts) as low, max(ts) as high from events",
        "parts": """select event_id, user_id, ts, case when event_id % 10 = 0 then 2 else
 cast(floor(3 * (epoch_us(ts) - epoch_us(low)) / (epoch_us(high) - epoch_us(low) + 1)) as int) end as part from events, bounds""",
    }
    before = "select null::bigint as user_id, null::timestamp as ts where false"
    for n in range(3):
        mark = f"(select max(ts) - interval 1 day from parts where part < {n})"
        steps[f"fine_{n}"] = f"select * from parts where part = {n} and ({mark} is null or ts > {mark})"
        steps[f"taken_{n}"] = f"""select user_id, min(ts) as ts from fine_{n} where user_id not in
 (select user_id from ({before}) where ts > {mark} - interval 1 day) group by user_id"""
        before += f" union all select user_id, ts from taken_{n}"
    judged = " union all ".join(
        f"""select {n} as cdc_batch, user_id, case when f.event_id is null then 'late'
 when row_number() over (partition by user_id, f.event_id is null order by p.ts) = 1 and user_id in (select user_id from taken_{n})
 then 'accepted' else 'repeat' end as status from parts p left join (select event_id from fine_{n}) f using (event_id) where part = {n}"""
        for n in range(3)
    )
    ctes = ", ".join(f"{name} as materialized ({sql})" for name, sql in steps.items())
    return f"""with {ctes} select cast(cdc_batch as int) as cdc_batch, status, count(*) as n_rows, count(distinct user_id) as n_users
 from ({judged}) group by all"""


_MD5_OF_PAYMENT = "(select *, md5(source_system || payment_id_raw) as payment_src_id from lines)"

ORACLE: dict[str, str] = {
    "bronze_online": ONLINE,
    "bronze_offline": OFFLINE,
    "csv_dialect_roundtrip": "select event_id, event_type, props from events",
    "csv_permissive": """select l_returnflag, count(*) as n_rows, count(l_orderkey) as n_keys,
 count(*) filter (l_returnflag <> 'R') as n_quantities, count(*) filter (l_returnflag = 'R') as n_rescued
 from lineitem group by l_returnflag""",
    "csv_rescue_quarantine": """select o_orderkey, o_orderstatus, o_orderpriority,
 case when o_orderstatus = 'P' then '{"extra":{"note":"late"}}' end as _rescued_data,
 case when o_orderstatus = 'P' then 'quarantine' else 'good' end as kind from orders""",
    "csv_header_order": """select o_orderkey, case when o_orderstatus <> 'P' then o_orderstatus end as o_orderstatus,
 o_orderpriority, case when o_orderstatus = 'F' then '{"extra":{"note":"x"}}' end as _rescued_data, mode
 from orders, (values ('batch'), ('stream')) m(mode)""",
    "csv_infer_schema": " union all ".join(
        f"select '{name}' as name, '{type_}' as type, count({name}) as n from customer"
        for name, type_ in [
            ("c_custkey", "int"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
            ("c_mktsegment", "string"),
        ]
    ),
    "ingest_rate_limit": "select 4::bigint as n_batches, 2::bigint as most_files, count(*) as n_rows from events",
    "normalize_headers": """select o_orderkey as order_key, o_orderstatus as order_status,
 o_orderpriority as order_priority_code from orders""",
    "file_lineage": """select count(*) as n_rows, count(*) as n_with_file, count(*) as n_with_time, true as one_instant
 from orders""",
    "stream_table_read": "select * from events",
    "table_metadata": _with(
        {"methods": METHODS},
        """select key, value, (select count(*) from methods) as n_rows from (values
 ('comment', 'methods of both channels'), ('quality', 'silver'), ('layer', 'silver_3nf')) t(key, value)""",
    ),
    "employee_changes": _with({}, _CHANGES),
    "tag_source": _with(
        {},
        """select Order_ID, payment_id, 'online' as source_system, null::varchar as source_entity from online
 union all select Order_ID, payment_id, 'offline', 'offline_bronze' from offline""",
    ),
    "audit_columns": _with(
        {}, "select count(*) as n_rows, count(*) as n_inserted, count(*) as n_updated, count(*) as n_equal from lines"
    ),
    "fn_trim": _with(
        {},
        """select distinct customer_email, City, trim(customer_email) as email, trim(City) as city_name,
 trim(chr(9) || ' ' || City) as tabbed from online""",
    ),
    "harmonize_country": _with(
        {},
        """select source_system, raw, case trim(raw) when 'USA' then 'United States' when 'UK' then 'United Kingdom'
 else trim(raw) end as country_name, count(*) as n_rows from (select 'online' as source_system, Country as raw from online
 union all select 'offline', store_country from offline) group by all""",
    ),
    "fn_md5_key": "select p_partkey, md5(p_name) as name_key, md5(cast(p_partkey as varchar)) as number_key from part",
    "fn_md5_concat_key": """select p_partkey, md5(p_name || p_brand) as pair_key,
 md5(p_name || case when p_size > 25 then p_brand end) as gap_key from part""",
    "fn_xxhash64_key": _with(
        {},
        f"""select order_src_id_raw, payment_id_raw, source_system, sales, order_id, payment_id, order_item_id
 from ({_item_id(f"({_payment_id(f'({_order_id(_MD5_OF_PAYMENT)})')})")})""",
    ),
    "fn_surrogate_key": f"""select p_partkey, {_sk('p_partkey')} as number_sk, {_sk('p_type', 'p_brand', 'p_name')} as path_sk,
 {_sk('p_type', 'case when p_size > 25 then p_brand end')} as gap_sk from part""",
    "fn_casts": """select o_orderkey, cast(substr(o_orderpriority, 1, 1) as int) as rank, try_cast(o_orderpriority as int) as no_number,
 cast(cast(o_orderkey as decimal(18,4)) + 0.0001::decimal(18,4) as decimal(18,4)) as amount,
 cast(cast(o_orderkey as decimal(10,2)) + 0.13::decimal(10,2) as decimal(10,2)) as salary,
 null::decimal(10,2) as overflow, cast(o_orderkey as varchar) as as_text from orders""",
    "fn_to_date": """select o_orderkey, cast(o_orderdate as date) as from_timestamp, cast(o_orderdate as date) as from_text,
 try_cast(o_orderpriority as date) as from_noise from orders""",
    "dict_category": _with({}, _dictionary(PRODUCT[:1])),
    "dict_sub_category": _with({}, _dictionary(PRODUCT[:2])),
    "source_coverage": _coverage(),
    "union_sources": _with(
        {}, "select payment_method, payment_provider, cast(payment_id_raw as bigint) as payment_id, source_system from lines"
    ),
    "lookup_left_single": _with(
        {},
        f"select category_name, sub_category_name, source_system, {_fk('category_name')} as category_id "
        f"from ({_dictionary(PRODUCT[:2])})",
    ),
    "lookup_left_composite": _with(
        {}, f"select payment_id_raw, {', '.join(METHOD)}, {_fk(*METHOD, required=2)} as method_id from lines"
    ),
    "lookup_path": _with({}, f"select *, {_fk(*PRODUCT[:2])} as sub_category_id from ({_dictionary(PRODUCT)})"),
    "lookup_leaf_fanout": _leaf_levels(),
    "city_state_lookup": _with(
        {"city": CITIES, "state": STATE},
        "select city_id, state_id, city_name, state_name from city join state using (state_id)",
    ),
    "flatten_geography": _with({}, FLAT_PLACES),
    "flatten_product": _with(
        {"d": DIM_PRODUCT}, "select product_id, product_name, sub_category_name, category_name from d"
    ),
    "dedup_store": _with(
        {},
        "select distinct store_src_id, store_name, city_name, state_name from lines where source_system = 'offline'",
    ),
    "dedup_customer_scd1": _with(
        {"customers": CUSTOMERS}, "select email, first_name, last_name, age, postal_code from customers"
    ),
    "dedup_product_name": _with(
        {"products": PRODUCTS},
        """select product_name, product_id, sub_category_name from products qualify row_number() over
 (partition by product_name order by product_id, sub_category_name) = 1""",
    ),
    "dedup_method": _with({"methods": METHODS}, "select payment_method, payment_provider, method_id from methods"),
    "date_bounds": "select min(o_orderdate)::date as min_d, max(o_orderdate)::date as max_d from orders",
    "silver_categories": _with({}, CATEGORY),
    "silver_sub_categories": _with({}, SUB_CATEGORY),
    "silver_products": _with({}, PRODUCTS),
    "silver_country": _with({}, COUNTRY),
    "silver_region": _with({}, REGION),
    "silver_state": _with({}, STATE),
    "silver_city": _with({}, CITIES),
    "silver_store": _with({}, STORES),
    "silver_customer": _with({}, CUSTOMERS),
    "silver_payment_methods": _with({}, METHODS),
    "silver_employee_scd2": _with({}, EMPLOYEE_HISTORY),
    "silver_orders": _with({}, _text_keys(ORDERS, *_ORDER_KEYS)),
    "silver_orders_items": _with({}, ITEMS),
    "silver_payment": _with({}, PAYMENT),
    "dim_customer": _with({"customers": CUSTOMERS, "places": FLAT_PLACES}, DIM_CUSTOMER),
    "dim_store": _with({"stores": STORES, "places": FLAT_PLACES}, DIM_STORE),
    "dim_product": _with({}, DIM_PRODUCT),
    "dim_payment_method": _with({"methods": METHODS}, "select method_id as payment_method_sk, * from methods"),
    "dim_employee": _with({}, DIM_EMPLOYEE),
    "dim_date": _with({}, DIM_DATE),
    "payment_per_order": _with({"payment": PAYMENT}, PER_ORDER),
    "payment_order_total": _with(
        {"payment": PAYMENT},
        """select order_id, cast(sum(payment_amount) as decimal(38,4)) as order_payment_total from payment
 where order_id is not null group by order_id""",
    ),
    "fact_sales": _with(_FACT_TABLES, _text_keys(FACT, *_FACT_KEYS)),
    "fact_sales_from_tables": _with(_FACT_TABLES, _text_keys(FACT, *_FACT_KEYS)),
    "fact_sales_bucketed": _with(_FACT_TABLES, _text_keys(FACT, *_FACT_KEYS), once=("lines",)),
    "fact_sales_star_joins": _with(_FACT_TABLES, _text_keys(FACT, *_FACT_KEYS)),
    "sales_report": _with(
        {},
        """select cast(year(order_date) as int) as year, country_name, category_name,
 cast(sum(sales) as decimal(38,4)) as sales, cast(sum(quantity) as bigint) as quantity, count(*) as lines
 from lines group by 1, 2, 3""",
    ),
    "scd1_customer": _with(
        {},
        """select email, order_date, first_name, last_name, phone_number, postal_code, city_name from lines
 where source_system = 'online' and email is not null and order_date is not null qualify row_number() over (partition by
 email order by order_date desc, first_name desc, last_name desc, phone_number desc, postal_code desc, city_name desc) = 1""",
    ),
    "scd1_events": """select user_id, ts, event_type, event_id from events where user_id is not null and ts is not null
 qualify row_number() over (partition by user_id order by ts desc, event_type desc, event_id desc) = 1""",
    "scd1_events_stream": """select user_id, ts, event_type, event_id from events
 qualify row_number() over (partition by user_id order by ts desc, event_type desc, event_id desc) = 1""",
    "scd2_events": EVENTS_HISTORY,
    "scd2_current": f"select * from ({EVENTS_HISTORY}) where end_at is null",
    "scd2_employees_current": _with(
        {}, f"select employee_sk, employee_src_id from ({DIM_EMPLOYEE}) where is_current"
    ),
    "scd2_events_stream": EVENTS_HISTORY,
    "stream_union": _with({}, "select source_system, order_src_id_raw, payment_id_raw, sales from lines"),
    "stream_dedup": _with({}, "select distinct source_system, order_src_id_raw, order_date from lines"),
    "stream_orders_fold": _with({}, """select source_system, order_src_id_raw, head.order_date as order_date, head.email as email,
 cast(head.store_src_id as varchar) as store_src_id from (
 select source_system, order_src_id_raw, min({'order_date': order_date - to_days(cast(cast(payment_id_raw as bigint) % 5 as int)),
 'email': email, 'store_src_id': store_src_id + cast(payment_id_raw as bigint) % 3 + 9007199254740993}) as head
 from lines group by source_system, order_src_id_raw)"""),
    "scd_quarantine": """with e as (select event_id, case when event_id % 97 <> 0 then user_id end as user_id,
 case when event_id % 89 <> 0 then ts end as ts, event_type from events)
 select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type, 'quarantine' as kind from e
 where user_id is null or ts is null
 union all select null, cast(user_id as varchar), max(event_type), 'log' from e where user_id is not null and ts is not null group by user_id, ts""",
    "stream_dedup_watermark": "select distinct user_id from events",
    "stream_static_orders": _with({}, _text_keys(ORDERS, *_ORDER_KEYS)),
    "stream_static_items": _with({}, ITEMS),
    "stream_static_payment": _with({}, PAYMENT, once=("lines",)),
    "stream_enrich": _with(
        {"customers": CUSTOMERS},
        f"""select source_system, payment_id_raw, lines.email, sales, payment_method, payment_provider,
 {_fk(*METHOD, required=2)} as method_id, cast(customer_id as varchar) as customer_id, customers.age from lines left join customers
 on lines.email = customers.email""".replace("select source_system", "select lines.source_system"),
        once=("lines", "customers"),
    ),
    "refresh_incremental_equals_full": _refresh(),
    "refresh_star_equals_full": _refresh_star(),
    "scd2_touched_cells": EVENTS_HISTORY,
    "csv_infer_by_name": """select 'o_orderkey' as name, 'bigint' as type, count(*) as n from orders
 union all select 'o_custkey', 'int', count(*) from orders union all select 'day', 'date', count(*) from orders
 union all select 'o_orderpriority', 'string', count(*) from orders where o_orderkey % 2 = 0
 union all select 'note', 'string', count(*) from orders where o_orderkey % 2 = 1""",
    "stream_dedup_late": _late(),
    "eda_filter_clustered": _with(
        {},
        """select customer_name, customer_surname, City from online where customer_name = 'BUILDING'
 and customer_surname = 'Customer#000000027'""",
    ),
    "eda_count_distinct": _with(
        {}, "select count(distinct payment_id) as n_payment_id, count(distinct Order_ID) as n_order_id from online"
    ),
    "eda_distinct": _with(
        {},
        """select distinct 'store_country' as what, store_country as value_0, null::varchar as value_1,
 null::varchar as value_2 from offline union all select distinct 'store_region', store_region, null, null from offline
 union all select distinct 'payment_provider', payment_provider, null, null from offline
 union all select distinct 'customer_name, customer_surname, City', customer_name, customer_surname, City from online""",
    ),
    "eda_projection": _with({}, "select Country, Region, State, City from online"),
    "eda_filter_conjunct": _with(
        {},
        """select customer_name, customer_surname, City from online where customer_name = 'BUILDING'
 and customer_surname = 'Customer#000000027'""",
    ),
}
