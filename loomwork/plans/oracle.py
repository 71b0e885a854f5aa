"""The registered queries once more, as SQL that DuckDB runs on the same tables.

Written from the definitions, not from the Spark code: no salts, blocks or heads of
partial results appear here. Fractions end in ``+ 0.0``, which turns -0.0 into 0.0.
"""

from __future__ import annotations

from loomwork.functions.text import PRIME, STOP_WORDS, hash_parameters
from loomwork.operators.weighted import sampling_parameters
from loomwork.plans.queries import ITEM, NODE, SAMPLES, USER

ORDER = "time_id, k1, k2, k3"
KEY = "stock_id, time_id, k1, k2, k3"


def r(expression: str, places: int = 6) -> str:
    unit = f"1e{places}"
    return f"floor(({expression}) * {unit} + 0.5) / {unit} + 0.0"


INPUTS = {
    "ratings": """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(1 + CAST(max(l_quantity) AS INT) % 5 AS INT) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey""",
    "users": """
SELECT c_custkey AS user_id, c_mktsegment AS segment, c_nationkey AS nation,
       CASE WHEN c_acctbal < 0 THEN 'negative'
            WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS balance_band
FROM customer""",
    "items": "SELECT p_partkey AS item_id, concat(p_type, '|', p_brand) AS genres FROM part",
    "edges": "SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem",
    "doc_topics": """
SELECT doc_id, source AS topic FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL
SELECT DISTINCT doc_id, 'toxic' AS topic FROM labels WHERE toxic = 1""",
    "book": """
SELECT stock_id, date_id, seconds_in_bucket,
       date_id * 1000 + seconds_in_bucket AS time_id, k1, k2, k3,
       p AS reference_price,
       CASE WHEN k2 = 3 THEN NULL ELSE p * 1.01::DOUBLE END AS far_price,
       p * 0.99::DOUBLE AS near_price,
       CASE WHEN k3 % 97 = 0 THEN NULL ELSE p * (1 + l_tax / 10) END AS ask_price,
       p * (1 - l_discount / 10) AS bid_price,
       p * (1 + (l_tax - l_discount) / 20) AS wap,
       q * 100 AS matched_size, q AS bid_size, 51 - q AS ask_size,
       abs(2 * q - 51) AS imbalance_size,
       (l_discount - l_tax) * 100 AS target
FROM (SELECT l_suppkey AS stock_id,
             CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT) AS date_id,
             (l_orderkey * 7 + l_linenumber) % 55 * 10 AS seconds_in_bucket,
             l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3,
             l_extendedprice / l_quantity AS p, l_quantity AS q, l_tax, l_discount
      FROM lineitem) t""",
    "weights": """
SELECT s_suppkey AS stock_id, 0.001::DOUBLE * (1 + s_suppkey % 8) AS weight FROM supplier""",
}
INPUTS["centered_user"] = """
SELECT user_id, item_id, rating - avg(rating) OVER (PARTITION BY user_id) AS x FROM ratings"""
INPUTS["centered_item"] = """
SELECT user_id, item_id, rating - avg(rating) OVER (PARTITION BY item_id) AS x FROM ratings"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_PARAMETERS = ", ".join(
    f"({i}, {a}::BIGINT, {b}::BIGINT)" for i, (a, b) in enumerate(hash_parameters(100))
)
INPUTS["words"] = rf"""
SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(lower(text),
         '\breuter\b', '', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '),
         lambda w: w <> '' AND NOT list_contains([{_STOP}], w)) AS t
FROM documents"""
INPUTS["grams"] = """
SELECT DISTINCT doc_id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] AS shingle
FROM (SELECT doc_id, t, unnest(generate_series(1, len(t) - 2)) AS i FROM words) u"""
_CHUNKS = " + ".join(
    f"{weight} * ('0x' || substr(m, {start}, 8))::BIGINT"
    for weight, start in ((8, 1), (4, 9), (2, 17), (1, 25))
)
INPUTS["sig"] = f"""
SELECT doc_id, i, min((a * h + b) % {PRIME}) AS v
FROM (SELECT doc_id, ({_CHUNKS}) % {PRIME} AS h
      FROM (SELECT doc_id, md5(shingle) AS m FROM grams) s) x,
     (VALUES {_PARAMETERS}) AS p(i, a, b)
GROUP BY doc_id, i"""
INPUTS["bands"] = """
SELECT doc_id, CAST(i // 2 AS INT) AS band, string_agg(v::VARCHAR, ',' ORDER BY i) AS bucket
FROM sig GROUP BY doc_id, i // 2"""
INPUTS["links"] = """
SELECT * FROM (
  SELECT band, min(doc_id) OVER w AS head_id, doc_id, count(*) OVER w AS bucket_docs
  FROM bands WINDOW w AS (PARTITION BY band, bucket)) t
WHERE bucket_docs > 1"""
INPUTS["pairs"] = """
SELECT a.doc_id AS doc_id_1, b.doc_id AS doc_id_2, CAST(count(*) AS INT) AS num_bands_matched
FROM links a JOIN links b
ON a.band = b.band AND a.head_id = b.head_id AND a.doc_id < b.doc_id
GROUP BY 1, 2"""

INPUTS["set_of"] = """
SELECT doc_id, n, min(doc_id) OVER (PARTITION BY key) AS set_id
FROM (SELECT doc_id, count(*) AS n, string_agg(shingle, '|' ORDER BY shingle) AS key FROM grams GROUP BY doc_id) s"""
INPUTS["similar_sets"] = """
SELECT set_id_1, set_id_2, common, a.n::BIGINT AS size_1, b.n::BIGINT AS size_2
FROM (SELECT a.doc_id AS set_id_1, b.doc_id AS set_id_2, count(*) AS common
      FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2) c
JOIN set_of a ON a.doc_id = set_id_1 JOIN set_of b ON b.doc_id = set_id_2
WHERE 100 * common >= 80 * (a.n + b.n - common)"""
INPUTS["held"] = "SELECT grams.* FROM grams JOIN set_of USING (doc_id) WHERE doc_id = set_id"
_MAPS = ", ".join(
    f"({k}, " + ", ".join(f"{a}::BIGINT, {b}::BIGINT" for a, b in maps) + ")"
    for k, maps in enumerate(sampling_parameters(SAMPLES, 42))
)
_MAP_NAMES = ", ".join(f"a{j}, b{j}" for j in range(5))
_UNIFORM = ", ".join(
    f"((a{j} * ('0x' || substr(m, {1 + 6 * j}, 6))::BIGINT + b{j}) % {PRIME} + 0.5::DOUBLE) / {PRIME} AS u{j}"
    for j in range(5)
)

DEPENDS = {
    "set_of": ["grams"],
    "held": ["grams", "set_of"],
    "similar_sets": ["held", "set_of"],
    "centered_user": ["ratings"],
    "centered_item": ["ratings"],
    "grams": ["words"],
    "sig": ["grams"],
    "bands": ["sig"],
    "links": ["bands"],
    "pairs": ["links"],
}


def _needed(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []
    for name in names:
        for part in [*_needed(tuple(DEPENDS.get(name, []))), name]:
            if part not in found:
                found.append(part)
    return found


def sql(body: str, *names: str, more: str = "") -> str:
    parts = [f"{n} AS MATERIALIZED ({INPUTS[n].strip()})" for n in _needed(names)]
    if more:
        parts.append(more)
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()


def _similar(axis: str, other: str, target: int) -> str:
    centered = f"centered_{axis[:4]}"
    return f"""
SELECT c.{axis}, {r("sum(c.x * m.x) / nullif(sqrt(sum(c.x * c.x)) * (SELECT sqrt(sum(x * x)) FROM " + centered + f" WHERE {axis} = {target}), 0)")} AS similarity
FROM {centered} c JOIN {centered} m ON c.{other} = m.{other} AND m.{axis} = {target}
WHERE c.{axis} <> {target} GROUP BY c.{axis}"""


def _top_rated_by(attribute: str) -> str:
    return sql(
        f"""SELECT item_id, {attribute}, {r('avg(rating)')} AS score
FROM ratings JOIN users USING (user_id) GROUP BY item_id, {attribute}""",
        "ratings",
        "users",
    )


def _pagerank(rounds: int = 10) -> str:
    parts = [
        "ids AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)",
        "outs AS MATERIALIZED (SELECT src, count(*) AS n FROM edges GROUP BY src)",
        "shares AS MATERIALIZED (SELECT src, dst, count(*) / any_value(n)::DOUBLE AS w"
        " FROM edges JOIN outs USING (src) GROUP BY src, dst)",
        "p0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM ids) AS v FROM ids)",
    ]
    for i in range(rounds):
        parts.append(
            f"""p{i + 1} AS MATERIALIZED (
SELECT ids.id, 0.15::DOUBLE / (SELECT count(*) FROM ids) + 0.85::DOUBLE * coalesce(s, 0) AS v
FROM ids LEFT JOIN (SELECT dst, sum(w * v) AS s FROM shares JOIN p{i} ON src = id GROUP BY dst) c
ON ids.id = c.dst)"""
        )
    body = f"SELECT id, {r('v', 9)} AS rank FROM p{rounds}"
    return sql(body, "edges", more=",\n".join(parts))


def _hits(rounds: int = 10) -> str:
    parts = [
        "ids AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)",
        "counted AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst)",
        "h0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS v FROM ids)",
    ]

    def step(name: str, before: str, come: str, go: str) -> list[str]:
        return [
            f"""{name}_raw AS MATERIALIZED (SELECT ids.id, coalesce(s, 0)::DOUBLE AS v FROM ids LEFT JOIN
(SELECT {go} AS id, sum(n * v) AS s FROM counted JOIN {before} ON {come} = id GROUP BY {go}) c
ON ids.id = c.id)""",
            f"""{name} AS MATERIALIZED (SELECT id, coalesce(v / nullif((SELECT sqrt(sum(v * v)) FROM {name}_raw), 0), v)
AS v FROM {name}_raw)""",
        ]

    for i in range(rounds):
        parts += step(f"a{i + 1}", f"h{i}", "src", "dst")
        parts += step(f"h{i + 1}", f"a{i + 1}", "dst", "src")
    body = f"""SELECT h.id, {r('h.v', 9)} AS hub, {r('a.v', 9)} AS auth
FROM h{rounds} h JOIN a{rounds} a ON h.id = a.id"""
    return sql(body, "edges", more=",\n".join(parts))


_BOOK_COLUMNS = [
    "stock_id", "date_id", "seconds_in_bucket", "time_id", "k1", "k2", "k3", "reference_price",
    "far_price", "near_price", "ask_price", "bid_price", "wap", "matched_size", "bid_size",
    "ask_size", "imbalance_size", "target",
]
_FRACTIONS = set(_BOOK_COLUMNS[7:])


def _book_row(**replaced: str) -> str:
    columns = []
    for c in _BOOK_COLUMNS:
        value = replaced.get(c, c)
        columns.append(f"{r(value) if c in _FRACTIONS else value} AS {c}")
    return ", ".join(columns)


_KEPT = """kept AS MATERIALIZED (SELECT * REPLACE (
  CASE WHEN seconds_in_bucket <= 300 THEN 0 ELSE near_price END AS near_price,
  CASE WHEN seconds_in_bucket <= 300 THEN 0 ELSE far_price END AS far_price)
FROM book WHERE ask_price IS NOT NULL)"""


def _filled(source: str, column: str, partition: str, order: str) -> str:
    by = f"PARTITION BY {partition}" if partition else ""
    return f"""numbered AS MATERIALIZED (
  SELECT *, row_number() OVER ({by} ORDER BY {order}) AS n FROM {source}),
ends AS MATERIALIZED (SELECT *,
  last_value(CASE WHEN {column} IS NOT NULL THEN n END IGNORE NULLS) OVER b AS n0,
  last_value({column} IGNORE NULLS) OVER b AS v0,
  first_value(CASE WHEN {column} IS NOT NULL THEN n END IGNORE NULLS) OVER f AS n1,
  first_value({column} IGNORE NULLS) OVER f AS v1
  FROM numbered
  WINDOW b AS ({by} ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS ({by} ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS MATERIALIZED (SELECT * REPLACE (
  CASE WHEN {column} IS NOT NULL THEN {column} WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0
       ELSE v0 + (v1 - v0) / (n1 - n0) * (n - n0) END AS {column}) FROM ends)"""


def _book_features() -> str:
    stages = """
a AS MATERIALIZED (SELECT book.*, ask_size + bid_size AS volume, (ask_price + bid_price) / 2 AS mid_price,
  ask_price - bid_price AS bid_ask_spread, bid_price / nullif(ask_price, 0) AS bid_ask_ratio,
  (bid_size - ask_size) / nullif(bid_size + ask_size, 0) AS liquidity_imbalance,
  weight AS stock_weight, weight * wap AS weighted_wap
  FROM book LEFT JOIN weights USING (stock_id)),
i AS MATERIALIZED (SELECT time_id, sum(weighted_wap) / nullif(sum(stock_weight), 0) AS indexwap
  FROM a GROUP BY time_id)"""
    fractions = {
        "volume": "volume",
        "mid_price": "mid_price",
        "bid_ask_spread": "bid_ask_spread",
        "bid_ask_ratio": "bid_ask_ratio",
        "liquidity_imbalance": "liquidity_imbalance",
        "market_urgency": "bid_ask_spread * liquidity_imbalance",
        "market_urgency_v2": "mid_price - (bid_price * bid_size + ask_price * ask_size) / nullif(volume, 0)",
        "price_pressure": "imbalance_size * bid_ask_spread",
        "depth_pressure": "(ask_size - bid_size) * (far_price - near_price)",
        "depth_pressure2": "volume * (far_price + near_price)",
        "stock_weight": "stock_weight",
        "weighted_wap": "weighted_wap",
        "indexwap": "indexwap",
        "indexwapdiff": "wap - indexwap",
        "imbalance_momentum": "(imbalance_size - lag(imbalance_size) OVER w) / nullif(matched_size, 0)",
        "spread_intensity": "bid_ask_spread - lag(bid_ask_spread) OVER w",
    }
    columns = ", ".join(f"{r(e, 4)} AS {n}" for n, e in fractions.items())
    return sql(
        f"""SELECT stock_id, time_id, k1, k2, k3, {columns} FROM a JOIN i USING (time_id)
WINDOW w AS (PARTITION BY stock_id ORDER BY {ORDER})""",
        "book",
        "weights",
        more=stages,
    )


_STOCK_FEATURES = {
    "median_size": "median(bid_size) + median(ask_size)",
    "std_size": "stddev_samp(bid_size) + stddev_samp(ask_size)",
    "ptp_size": "max(bid_size) - min(bid_size)",
    "median_price": "median(bid_price) + median(ask_price)",
    "std_price": "stddev_samp(bid_price) + stddev_samp(ask_price)",
    "ptp_price": "max(bid_price) - min(ask_price)",
}


def _stock_features() -> str:
    columns = ", ".join(f"{r(e)} AS global_{n}" for n, e in _STOCK_FEATURES.items())
    return f"SELECT stock_id, {columns} FROM book GROUP BY stock_id"


def _stream_features() -> str:
    stocks = _stock_features().replace("FROM book", "FROM rows_in")
    stages = f"""
rows_in AS MATERIALIZED (SELECT book.*, ask_price - bid_price AS gap, weight
  FROM book LEFT JOIN weights USING (stock_id) WHERE ask_price IS NOT NULL),
i AS MATERIALIZED (SELECT time_id, sum(weight * wap) / nullif(sum(weight), 0) AS indexwap FROM rows_in GROUP BY time_id),
s AS MATERIALIZED ({stocks})"""
    return sql(
        f"""SELECT stock_id, time_id, k1, k2, k3,
  {r('(imbalance_size - lag(imbalance_size) OVER w) / nullif(matched_size, 0)', 4)} AS imbalance_momentum,
  {r('gap - lag(gap) OVER w', 4)} AS spread_intensity,
  {r('wap - indexwap', 4)} AS indexwapdiff, {r('global_median_size', 4)} AS global_median_size
FROM rows_in JOIN i USING (time_id) JOIN s USING (stock_id)
WINDOW w AS (PARTITION BY stock_id ORDER BY {ORDER})""",
        "book",
        "weights",
        more=stages,
    )


def _row_stats() -> str:
    groups = {
        "all_prices": ["reference_price", "far_price", "near_price", "ask_price", "bid_price", "wap"],
        "all_sizes": ["matched_size", "bid_size", "ask_size", "imbalance_size"],
    }
    parts, columns = [], []
    for name, members in groups.items():
        values = f"list_filter([{', '.join(members)}], lambda v: v IS NOT NULL)"
        parts.append(f"{values} AS {name}")

        def guarded(statistic: str, least: int, name: str = name) -> str:
            aggregate = f"list_{statistic}({name})"
            return (
                f"CASE WHEN len({name}) < {least} THEN NULL "
                f"WHEN list_min({name}) = list_max({name}) THEN 0 ELSE {aggregate} END"
            )

        columns += [
            f"{r(f'list_avg({name})', 4)} AS {name}_mean",
            f"{r(guarded('stddev_samp', 2), 4)} AS {name}_std",
            f"{r(guarded('skewness', 3), 4)} AS {name}_skew",
            f"{r(guarded('kurtosis', 4), 4)} AS {name}_kurt",
            f"{r(f'list_max({name})', 4)} AS {name}_max",
        ]
    return sql(
        f"SELECT {KEY}, {', '.join(columns)} FROM lists",
        "book",
        more=f"lists AS MATERIALIZED (SELECT {KEY}, {', '.join(parts)} FROM book)",
    )


def _folds(source: str) -> str:
    return f"""
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY time_id, stock_id, k1, k2, k3) - 1 AS n,
         count(*) OVER () AS total FROM {source}),
folded AS MATERIALIZED (SELECT *, CAST(CASE
  WHEN n < total - 5 * (total // 6) THEN -1
  ELSE (n - (total - 5 * (total // 6))) // (total // 6) END AS INT) AS fold FROM ranked)"""


_FOLDS = _folds("book")


def _null_profile() -> str:
    each = [
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM book" for c in _BOOK_COLUMNS
    ]
    rows = " UNION ALL ".join(each)
    return sql(
        "SELECT * FROM counts UNION ALL SELECT 'total', CAST(sum(nulls) AS BIGINT) FROM counts",
        "book",
        more=f"counts AS MATERIALIZED ({rows})",
    )


def _narrow() -> str:
    columns = [
        f"{r(f'CAST(CAST({c} AS FLOAT) AS DOUBLE)', 2)} AS {c}" if c in _FRACTIONS else c
        for c in _BOOK_COLUMNS
    ]
    return f"SELECT {', '.join(columns)} FROM book"


def _unescaped(text: str) -> str:
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{sign}')"
    return text


_METRICS = """
topics AS MATERIALIZED (SELECT doc_id, list(DISTINCT topic) AS t FROM doc_topics GROUP BY doc_id),
judged AS MATERIALIZED (
  SELECT list_has_any(a.t, b.t) AS same, p.doc_id_1 IS NOT NULL AS found
  FROM topics a JOIN topics b ON a.doc_id < b.doc_id
  LEFT JOIN pairs p ON p.doc_id_1 = a.doc_id AND p.doc_id_2 = b.doc_id),
c AS MATERIALIZED (SELECT count(*) FILTER (found AND same) AS tp, count(*) FILTER (found AND NOT same) AS fp,
  count(*) FILTER (NOT found AND same) AS fn, count(*) FILTER (NOT found AND NOT same) AS tn FROM judged),
m AS MATERIALIZED (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM c)"""


def oracle_sql() -> dict[str, str]:
    lags = ", ".join(
        f"{r(f'{c} - lag({c}, {n}) OVER w')} AS {c}_diff{n}" for n in (1, 2, 3, 10) for c in ("wap", "bid_size")
    )
    seen = f"SELECT item_id FROM ratings WHERE user_id = {USER}"
    return {
        "sorted_csv_sink": sql(
            f"SELECT item_id, {r('avg(rating)')} AS score FROM ratings GROUP BY item_id", "ratings"
        ),
        "top_rated": sql(
            f"SELECT item_id, {r('avg(rating)')} AS score FROM ratings GROUP BY item_id", "ratings"
        ),
        "top_rated_by_segment": _top_rated_by("segment"),
        "top_rated_by_nation": _top_rated_by("nation"),
        "top_rated_by_balance_band": _top_rated_by("balance_band"),
        "user_means": sql(
            f"SELECT user_id, {r('avg(rating)')} AS score FROM ratings GROUP BY user_id", "ratings"
        ),
        "user_genre_means": sql(
            f"""SELECT user_id, genres AS genre, {r('avg(rating)')} AS score
FROM ratings JOIN items USING (item_id) GROUP BY user_id, genres""",
            "ratings",
            "items",
        ),
        "user_single_genre_means": sql(
            f"""SELECT user_id, genre, {r('avg(rating)')} AS score FROM ratings JOIN
(SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM items) g USING (item_id)
GROUP BY user_id, genre""",
            "ratings",
            "items",
        ),
        "centered_by_user": sql(
            f"SELECT user_id, item_id, {r('x')} AS centered FROM centered_user", "centered_user"
        ),
        "centered_by_item": sql(
            f"SELECT user_id, item_id, {r('x')} AS centered FROM centered_item", "centered_item"
        ),
        "similar_users": sql(_similar("user_id", "item_id", USER), "centered_user"),
        "similar_items": sql(_similar("item_id", "user_id", ITEM), "centered_item"),
        "recommend_user_based": sql(
            f"""SELECT item_id, {r('sum(x * s) / nullif(sum(abs(s)), 0)')} AS score
FROM centered_item JOIN sims USING (user_id)
WHERE item_id NOT IN ({seen}) GROUP BY item_id
ORDER BY sum(x * s) / nullif(sum(abs(s)), 0) DESC NULLS LAST, item_id LIMIT 10""",
            "centered_user",
            "centered_item",
            more=f"""sims AS MATERIALIZED (SELECT c.user_id, sum(c.x * m.x) / nullif(sqrt(sum(c.x * c.x)) *
(SELECT sqrt(sum(x * x)) FROM centered_user WHERE user_id = {USER}), 0) AS s
FROM centered_user c JOIN centered_user m ON c.item_id = m.item_id AND m.user_id = {USER}
WHERE c.user_id <> {USER} GROUP BY c.user_id)""",
        ),
        "recommend_item_based": sql(
            f"""SELECT item_id, {r('sum(s * x) / nullif(sum(abs(s)), 0)')} AS score
FROM sims JOIN mine ON sims.seen = mine.seen WHERE item_id NOT IN (SELECT seen FROM mine) GROUP BY item_id
ORDER BY sum(s * x) / nullif(sum(abs(s)), 0) DESC NULLS LAST, item_id LIMIT 10""",
            "centered_item",
            more=f"""mine AS MATERIALIZED (SELECT item_id AS seen, x FROM centered_item WHERE user_id = {USER}),
norms AS MATERIALIZED (SELECT item_id, sqrt(sum(x * x)) AS n FROM centered_item GROUP BY item_id),
dots AS MATERIALIZED (SELECT a.item_id AS seen, b.item_id, sum(a.x * b.x) AS d
  FROM centered_item a JOIN centered_item b ON a.user_id = b.user_id
  WHERE a.item_id IN (SELECT seen FROM mine) GROUP BY a.item_id, b.item_id),
sims AS MATERIALIZED (SELECT seen, dots.item_id, d / nullif(p.n * q.n, 0) AS s
  FROM dots JOIN norms p ON seen = p.item_id JOIN norms q ON dots.item_id = q.item_id)""",
        ),
        "out_degree": sql(
            "SELECT src AS node, count(DISTINCT dst) AS out_degree FROM edges GROUP BY src", "edges"
        ),
        "sketched_in_degree": sql(
            "SELECT dst AS node, count(DISTINCT src) AS degree FROM edges GROUP BY dst", "edges"
        ),
        "in_degree": sql(
            "SELECT dst AS node, count(DISTINCT src) AS in_degree FROM edges GROUP BY dst", "edges"
        ),
        "adjacency": sql(
            """SELECT src AS node, 'out' AS direction, 0::INT AS segment,
  string_agg(dst::VARCHAR, ',' ORDER BY dst) AS neighbours FROM edges GROUP BY src
UNION ALL SELECT dst, 'in', 0::INT, string_agg(src::VARCHAR, ',' ORDER BY src) FROM edges GROUP BY dst""",
            "edges",
        ),
        "neighbors": sql(
            f"""SELECT 'out' AS direction, dst AS neighbour, count(*) AS edges FROM edges WHERE src = {NODE} GROUP BY dst
UNION ALL SELECT 'in', src, count(*) FROM edges WHERE dst = {NODE} GROUP BY src""",
            "edges",
        ),
        "pagerank": _pagerank(),
        "hits": _hits(),
        "shingles": sql(
            """SELECT doc_id, count(shingle)::INT AS num_shingles,
  md5(coalesce(string_agg(shingle, '|' ORDER BY shingle), '')) AS shingles_md5
FROM documents LEFT JOIN grams USING (doc_id) GROUP BY doc_id""",
            "grams",
        ),
        "idf": sql(
            f"""SELECT shingle, count(*) AS df,
  {r('ln((SELECT count(*) FROM documents) / count(*))')} AS idf FROM grams GROUP BY shingle""",
            "grams",
        ),
        "set_representation": sql("SELECT shingle, doc_id, '1' AS value FROM grams", "grams"),
        "minhash_signatures": sql(
            "SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY i) AS signature FROM sig GROUP BY doc_id",
            "sig",
        ),
        "signature_matrix": sql(
            "SELECT i::VARCHAR AS hash_function_index, doc_id, v::VARCHAR AS signature_value FROM sig",
            "sig",
        ),
        "lsh_bands": sql("SELECT doc_id, band, bucket FROM bands", "bands"),
        "candidate_links": sql("SELECT band, head_id, doc_id, bucket_docs FROM links", "links"),
        "candidate_pairs": sql("SELECT * FROM pairs", "pairs"),
        "candidate_pairs_two_bands": sql(
            "SELECT * FROM pairs WHERE num_bands_matched >= 2", "pairs"
        ),
        "pair_metrics": sql(
            f"""SELECT tp, fp, fn, tn, {r('accuracy')} AS accuracy, {r('precision')} AS precision,
  {r('recall')} AS recall,
  {r('coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)')} AS f1,
  (SELECT count(*) FROM documents) - (SELECT count(*) FROM topics) AS documents_with_no_topics FROM m""",
            "pairs",
            "doc_topics",
            more=_METRICS,
        ),
        "similar_sets": sql("SELECT * FROM similar_sets", "similar_sets"),
        "lsh_recall": sql(
            f"""SELECT count(*) AS similar_pairs, count(num_bands_matched) AS found,
  {r('count(num_bands_matched) / nullif(count(*), 0)')} AS recall
FROM similar_sets LEFT JOIN pairs ON doc_id_1 = set_id_1 AND doc_id_2 = set_id_2""",
            "similar_sets",
            "pairs",
        ),
        "weighted_signatures": sql(
            f"""SELECT doc_id, k::INT AS k, shingle, t FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY ln(c) - r * (t - u4) - r) AS place FROM (
    SELECT *, floor(ln(w) / r + u4)::BIGINT AS t FROM (
      SELECT doc_id, shingle, k, w, -ln(u0 * u1) AS r, -ln(u2 * u3) AS c, u4 FROM (
        SELECT doc_id, shingle, k, w, {_UNIFORM}
        FROM (SELECT doc_id, shingle, md5(shingle) AS m, w FROM grams JOIN (
                SELECT shingle, ln((SELECT count(*) FROM documents) / count(*)) AS w FROM grams GROUP BY shingle) i
              USING (shingle) WHERE w > 0) g,
             (VALUES {_MAPS}) AS p(k, {_MAP_NAMES})) a) b) d) e
WHERE place = 1""",
            "grams",
        ),
        "clean_book": sql(
            f"SELECT {_book_row()} FROM filled",
            "book",
            more=_KEPT + ",\n" + _filled("kept", "far_price", "stock_id", ORDER),
        ),
        "clean_book_whole": sql(
            f"SELECT {_book_row()} FROM filled",
            "book",
            more=_KEPT
            + ",\n"
            + _filled("kept", "far_price", "", "date_id, seconds_in_bucket, stock_id, k1, k2, k3"),
        ),
        "interpolate": sql(
            f"SELECT {KEY}, {r('ask_price')} AS ask_price FROM filled",
            "book",
            more=_filled("book", "ask_price", "stock_id", ORDER),
        ),
        "lag_diff": sql(
            f"SELECT {KEY}, {lags} FROM book WINDOW w AS (PARTITION BY stock_id ORDER BY {ORDER})",
            "book",
        ),
        "null_profile": _null_profile(),
        "book_features": _book_features(),
        "stock_features": sql(_stock_features(), "book"),
        "global_features": sql(
            f"SELECT {KEY}, {', '.join(f'global_{n}' for n in _STOCK_FEATURES)} FROM book JOIN s USING (stock_id)",
            "book",
            more=f"s AS MATERIALIZED ({_stock_features()})",
        ),
        "time_features": sql(
            f"""SELECT {KEY}, date_id % 5 AS day_of_week, seconds_in_bucket % 60 AS seconds,
  seconds_in_bucket // 60 AS minute FROM book""",
            "book",
        ),
        "row_stats": _row_stats(),
        "narrow_types": sql(_narrow(), "book"),
        "time_series_folds": sql(f"SELECT {KEY}, fold FROM folded", "book", more=_FOLDS),
        "fold_days": sql(
            """SELECT f.fold, (SELECT count(DISTINCT date_id) FROM folded t WHERE t.fold < f.fold) AS training_days,
  count(DISTINCT date_id) AS validation_days, min(date_id) AS first_day, max(date_id) AS last_day
FROM folded f WHERE fold >= 0 GROUP BY f.fold""",
            "book",
            more=_FOLDS,
        ),
        "delimited_scan": sql(
            "SELECT CAST(user_id AS INT) AS user_id, CAST(item_id AS INT) AS item_id, rating FROM ratings",
            "ratings",
        ),
        "edge_list_scan": sql("SELECT src, dst FROM edges", "edges"),
        "headed_csv_scan": sql(
            f"SELECT {KEY}, {r('far_price')} AS far_price, {r('ask_price')} AS ask_price FROM book", "book"
        ),
        "tagged_records": f"""SELECT page_id, record,
  {_unescaped("regexp_extract(record, 'href=\"([^\"]*)\"', 1)")} AS href
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li[^>]*>.*?</li>')) AS record FROM pages) t""",
        "tagged_documents": sql(
            r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')) AS body_md5,
  coalesce(string_agg(topic, ',' ORDER BY topic), '') AS topics
FROM documents LEFT JOIN doc_topics USING (doc_id) WHERE lang = 'en' GROUP BY doc_id, text""",
            "doc_topics",
        ),
        "kept_features": sql(
            """SELECT date_id % 5 AS day_of_week, seconds_in_bucket // 60 AS minute, count(*) AS rows
FROM book GROUP BY 1, 2""",
            "book",
        ),
        "tagged_documents_all": sql(
            r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')) AS body_md5,
  coalesce(string_agg(topic, ',' ORDER BY topic), '') AS topics
FROM documents LEFT JOIN doc_topics USING (doc_id) GROUP BY doc_id, text""",
            "doc_topics",
        ),
        "headless_csv_scan": sql(f"SELECT {KEY}, {r('wap')} AS wap, 3::INT AS files FROM book", "book"),
        "inferred_csv_scan": sql(
            f"SELECT {KEY}, {r('ask_price')} AS ask_price, 'int,int,int,int,int,double' AS types FROM book", "book"
        ),
        "constant_mae": sql(
            f"""SELECT fold::INT AS fold, training_rows, {r('constant')} AS constant, count(target) AS rows,
  {r('avg(abs(target - constant))')} AS constant_mae
FROM (SELECT fold, target FROM folded WHERE fold >= 0
      UNION ALL SELECT 5, target FROM book WHERE ask_price IS NOT NULL AND date_id > 110) p
JOIN (SELECT f.fold, count(*) AS training_rows, median(t.target) AS constant
      FROM range(6) f(fold) JOIN folded t ON t.fold < f.fold GROUP BY f.fold) c USING (fold)
GROUP BY fold, training_rows, constant""",
            "book",
            more="training AS MATERIALIZED (SELECT * FROM book WHERE ask_price IS NOT NULL AND date_id <= 110),"
            + _folds("training"),
        ),
        # the stock itself, the book's own numbers, and what was added to them
        "model_features": sql(
            """SELECT column_name AS feature FROM (DESCRIBE book)
WHERE column_name NOT IN ('date_id', 'time_id', 'k1', 'k2', 'k3', 'target')
UNION ALL SELECT unnest(string_split(
  'volume mid_price bid_ask_spread bid_ask_ratio liquidity_imbalance market_urgency market_urgency_v2 '
  || 'price_pressure depth_pressure depth_pressure2 imbalance_momentum spread_intensity indexwap indexwapdiff '
  || 'stock_weight weighted_wap day_of_week seconds minute', ' '))
UNION ALL SELECT 'global_' || unnest(['median_size', 'std_size', 'ptp_size', 'median_price', 'std_price', 'ptp_price'])
UNION ALL SELECT g || '_' || s FROM (SELECT unnest(['all_prices', 'all_sizes']) AS g),
  (SELECT unnest(['mean', 'std', 'skew', 'kurt', 'max']) AS s)""",
            "book",
        ),
        "stream_scores": sql(
            "SELECT date_id, count(*) AS rows FROM book WHERE ask_price IS NOT NULL AND date_id > 110 GROUP BY date_id",
            "book",
        ),
        "stream_features": _stream_features(),
    }
