"""Independent SQL for every registered query, to be run by another engine on the same files.

Money is handled as integer cents and every rounded figure by integer division, so no binary
fraction decides a rounding. Integers are BIGINT and rounded decimals DOUBLE on both sides.
"""

from __future__ import annotations

STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
    "ELSE CASE WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'delivered' END END"
)
SCORE = (
    "CASE WHEN o_orderkey * 13 % 10 <= 5 THEN 5 WHEN o_orderkey * 13 % 10 = 6 THEN 4 "
    "WHEN o_orderkey * 13 % 10 = 7 THEN 3 WHEN o_orderkey * 13 % 10 = 8 THEN 2 ELSE 1 END"
)
BRAND = "CAST(substr(p_brand, 7) AS INT)"
TITLE = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

# Labels of the fact keys.
FACT_KEY_LABELS = ["fact_order_items.order_item_sk", "fact_payments.payment_sk", "fact_reviews.review_sk"]


def later(seconds: str) -> str:
    return f"o_orderdate + ({seconds}) * INTERVAL 1 SECOND"


CTES: dict[str, tuple[list[str], str]] = {
    "ord": (
        [],
        f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, {STATUS} AS order_status,
            {later('o_orderkey * 31 % 86400')} AS bought,
            CASE WHEN {STATUS} <> 'canceled'
                 THEN {later('o_orderkey * 31 % 86400 + 600 + o_orderkey % 7200')} END AS approved,
            CASE WHEN {STATUS} = 'delivered' THEN {later('86400 + o_orderkey % 3600')} END AS carrier,
            CASE WHEN {STATUS} = 'delivered'
                 THEN {later('86400 * (1 + o_orderkey * 7919 % 45) + o_orderkey * 104729 % 86400')} END AS received,
            {later('86400 * (10 + o_orderkey % 5 * 7)')} AS estimated,
            CAST(o_orderdate AS DATE) AS day
            FROM orders""",
    ),
    "item": (
        [],
        """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
            l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, price_c, freight_c,
            price_c + freight_c AS total_c
            FROM (SELECT *, (price_c * CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS BIGINT) + 50) // 100 AS freight_c
                  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS price_c
                        FROM lineitem))""",
    ),
    "cust": (
        [],
        f"""SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
            lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip, c_mktsegment AS city, n_name AS state,
            {TITLE.format('c_mktsegment')} AS clean_city
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "sell": (
        [],
        f"""SELECT s_suppkey AS seller_id, lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS zip,
            {TITLE.format('r_name')} AS city, n_name AS state
            FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "prod": (
        [],
        f"""SELECT p_partkey AS product_id, CASE WHEN p_size <> 50 THEN p_brand END AS raw,
            CASE WHEN p_size <> 50 AND {BRAND} <= 20 THEN 'cat_' || {BRAND} END AS english,
            CASE WHEN p_size <> 50 THEN length(p_name) END AS name_lenght,
            CASE WHEN p_size <> 50 THEN p_size * 10 END AS description_lenght,
            CASE WHEN p_size <> 50 THEN p_size % 6 + 1 END AS photos,
            CASE WHEN p_size <> 49 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS weight,
            p_size + 10 AS length_cm, p_size % 30 + 2 AS height_cm, p_size % 20 + 5 AS width_cm
            FROM part""",
    ),
    "trans": (
        [],
        f"SELECT DISTINCT p_brand AS raw, 'cat_' || {BRAND} AS english FROM part WHERE {BRAND} <= 20",
    ),
    "pay": (
        [],
        """SELECT o_orderkey AS order_id, 1 AS seq,
            CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'boleto' WHEN '5' THEN 'voucher'
                 ELSE 'credit_card' END AS payment_type,
            1 + o_orderkey % 14 AS installments, CAST(CAST(o_totalprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS value_c
            FROM orders""",
    ),
    "rev": (
        [],
        f"""SELECT o_orderkey || '-' || seq AS review_id, o_orderkey AS order_id, score,
            CASE WHEN o_orderkey % 4 = 0 THEN 'title ' || score END AS title,
            CASE WHEN o_orderkey % 3 = 0 THEN 'said, "fine"' END AS message,
            {later('86400 * 20')} AS created, {later('86400 * 22 + o_orderkey % 86400')} AS answered
            FROM (SELECT *, 1 AS seq, {SCORE} AS score FROM orders WHERE o_orderkey % 20 <> 0
                  UNION ALL SELECT *, 2, 1 FROM orders WHERE o_orderkey % 97 = 1)""",
    ),
    "fact": (
        ["ord", "item"],
        "SELECT i.*, o.customer_id, o.day FROM item i JOIN ord o ON i.order_id = o.order_id",
    ),
    # The same tables with the faults of ``StandIn.soiled``.
    "sfact": (
        ["ord", "item"],
        """SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
            CASE WHEN i.order_id % 80 = 9 THEN -price_c ELSE price_c END AS price_c, freight_c,
            CASE WHEN i.order_id % 80 = 9 THEN -price_c ELSE price_c END + freight_c AS total_c, o.customer_id, o.day
            FROM item i JOIN (SELECT * FROM ord UNION ALL SELECT * FROM ord WHERE order_id % 100 = 1) o
            ON i.order_id = o.order_id WHERE o.order_id % 150 <> 2 AND i.order_id % 200 <> 7""",
    ),
    "spay": (
        ["pay"],
        "SELECT order_id FROM pay UNION ALL SELECT -order_id FROM pay WHERE order_id % 40 = 3",
    ),
    "srev": (
        ["rev"],
        """SELECT order_id, score FROM rev
            UNION ALL SELECT -order_id, 7 FROM rev WHERE order_id % 60 = 5 AND review_id = order_id || '-1'""",
    ),
    "calendar": (
        ["ord"],
        """SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS full_date FROM ord""",
    ),
    "order_rev": (
        ["item"],
        """SELECT order_id, sum(price_c) AS revenue_c, sum(freight_c) AS freight_c, count(*) AS n_items
            FROM item GROUP BY order_id""",
    ),
    "enriched": (
        ["ord", "order_rev", "cust"],
        """SELECT o.*, r.revenue_c, r.freight_c, r.n_items, c.state AS customer_state, c.city AS customer_city
            FROM ord o LEFT JOIN order_rev r ON o.order_id = r.order_id
            LEFT JOIN cust c ON o.customer_id = c.customer_id""",
    ),
    "delivered": (
        ["ord", "cust"],
        """SELECT o.order_id, o.customer_id, c.state AS customer_state,
            CAST(floor((epoch_us(received) - epoch_us(bought)) / 86400000000) AS BIGINT) AS dias_entrega,
            CAST(floor((epoch_us(estimated) - epoch_us(received)) / 86400000000) AS BIGINT) AS dias_vs_estimado
            FROM ord o LEFT JOIN cust c ON o.customer_id = c.customer_id
            WHERE order_status = 'delivered' AND received IS NOT NULL AND bought IS NOT NULL""",
    ),
    "valued": (
        ["ord", "order_rev"],
        """SELECT o.order_id, r.revenue_c, r.n_items FROM ord o JOIN order_rev r ON o.order_id = r.order_id
            WHERE order_status = 'delivered'""",
    ),
}


def query(ctes: list[str], body: str, **extra: str) -> str:
    """Prefix ``body`` with the named CTEs, what they need, and the extra ones in order."""
    done: list[str] = []

    def need(name: str) -> None:
        for dependency in CTES[name][0]:
            need(dependency)
        if name not in done:
            done.append(name)

    for name in ctes:
        need(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in done] + [f"{name} AS ({sql})" for name, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}"


def div(num: str, den: str, digits: int = 0) -> str:
    """num / den rounded half away from zero to ``digits`` places, as DOUBLE; NULL for den = 0."""
    n, d = f"(CAST({num} AS HUGEINT) * {10**digits})", f"CAST({den} AS HUGEINT)"
    exact = f"sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    return f"(CASE WHEN {den} <> 0 THEN CAST({exact} AS DOUBLE) / {float(10**digits)!r} END)".replace("/ 1.0 ", "")


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 1e2)"


def mean_money(cents: str, count: str, digits: int = 2) -> str:
    return div(cents, f"(100 * ({count}))", digits)


def money_text(cents: str, symbol: str = "$", digits: int = 2) -> str:
    return f"'{symbol}' || format('{{:,.{digits}f}}', {cents})"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def pct(part: str, whole: str) -> str:
    """Unrounded double share, with the operations in the same order as in the library."""
    return f"(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100)"


def pct_money(part: str, whole: str) -> str:
    return f"({money(part)} / {money(whole)} * 100)"


def true_pct(predicate: str) -> str:
    return f"(CAST(sum(CASE WHEN {predicate} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100)"


def interpolated(source: str, value: str, fractions: dict[str, tuple[int, int]], by: str | None = None) -> str:
    """Rows (by, <name> scaled as 1e6 of the value's unit) by walking to the two order statistics."""
    part = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    picks = ", ".join(
        f"max(CASE WHEN rn = (n - 1) * {a} // {b} + 1 THEN {value} END) * 1000000 + "
        f"(coalesce(max(CASE WHEN rn = (n - 1) * {a} // {b} + 2 THEN {value} END), max({value})) - "
        f"max(CASE WHEN rn = (n - 1) * {a} // {b} + 1 THEN {value} END)) * "
        f"(max(n - 1) * {a} % {b}) * 1000000 // {b} AS {name}"
        for name, (a, b) in fractions.items()
    )
    group = f"GROUP BY {by}" if by else ""
    return (
        f"SELECT {key}{picks} FROM (SELECT *, row_number() OVER ({part} ORDER BY {value}) AS rn, "
        f"count(*) OVER ({part}) AS n FROM {source}) {group}"
    )


def histogram(source: str, value: str, bins: int, unit: str = "1e0") -> str:
    """Integer-valued histogram: exact bin numbers by integer division."""
    return f"""SELECT {big('b.bin')} AS bin,
        CASE WHEN lo = hi THEN lo / {unit} - 0.5::DOUBLE ELSE lo / {unit} END
          + CASE WHEN lo = hi THEN 1e0 ELSE hi / {unit} - lo / {unit} END * b.bin / {bins} AS desde,
        CASE WHEN lo = hi THEN lo / {unit} - 0.5::DOUBLE ELSE lo / {unit} END
          + CASE WHEN lo = hi THEN 1e0 ELSE hi / {unit} - lo / {unit} END * (b.bin + 1) / {bins} AS hasta,
        {big('coalesce(n, 0)')} AS n
        FROM (SELECT CAST(unnest(range({bins})) AS DOUBLE) AS bin) b
        CROSS JOIN (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source}) e
        LEFT JOIN (SELECT CASE WHEN h = l THEN {bins // 2} ELSE least({bins - 1}, ({value} - l) * {bins} // (h - l)) END
                   AS bin, count(*) AS n FROM {source},
                   (SELECT min({value}) AS l, max({value}) AS h FROM {source}) GROUP BY 1) c ON c.bin = b.bin"""


def _views() -> dict[str, str]:
    monthly = """SELECT year(day) AS y, month(day) AS m, monthname(day) AS month_name, sum(total_c) AS rev,
        count(DISTINCT order_id) AS n_orders, count(*) AS n FROM fact GROUP BY 1, 2, 3"""
    monthly_revenue = f"""SELECT {big('y')} AS year, {big('m')} AS month, month_name, {money('rev')} AS revenue,
        n_orders AS total_ordenes, {mean_money('rev', 'n')} AS ticket_promedio,
        {money('prev')} AS revenue_mes_anterior, {div('(rev - prev) * 100', 'prev', 2)} AS crecimiento_pct
        FROM (SELECT *, lag(rev) OVER (ORDER BY y, m) AS prev FROM monthly)"""
    cats = """SELECT english, sum(total_c) AS rev, count(*) AS n FROM fact f
        JOIN prod p ON f.product_id = p.product_id GROUP BY english"""
    pareto = f"""SELECT coalesce(english, 'Sin categoría') AS categoria, {money('rev')} AS revenue, n AS total_items,
        {div('rev * 100', 'total', 2)} AS pct_del_total, {div('upto * 100', 'total', 2)} AS pct_acumulado,
        rank() OVER (ORDER BY rev DESC) AS ranking,
        CASE WHEN upto * 10 <= total * 8 THEN 'Top 80%' ELSE 'Restante 20%' END AS segmento_pareto
        FROM (SELECT *, sum(rev) OVER (ORDER BY rev DESC) AS upto, sum(rev) OVER () AS total FROM cats)"""
    sellers = """SELECT s.seller_id, s.city, s.state, sum(total_c) AS rev, count(*) AS n,
        count(DISTINCT order_id) AS n_orders, count(DISTINCT product_id) AS n_products, min(day) AS first_day,
        max(day) AS last_day FROM fact f JOIN sell s ON f.seller_id = s.seller_id GROUP BY 1, 2, 3"""
    ranking = f"""SELECT *, rank() OVER (ORDER BY revenue_total DESC) AS ranking_revenue,
        rank() OVER (ORDER BY total_ordenes DESC) AS ranking_ordenes,
        rank() OVER (ORDER BY ticket_promedio DESC) AS ranking_ticket
        FROM (SELECT seller_id, city AS seller_city, state AS seller_state, {money('rev')} AS revenue_total,
              n_orders AS total_ordenes, {mean_money('rev', 'n')} AS ticket_promedio,
              n_products AS productos_distintos FROM sellers)"""
    states = """SELECT c.state, sum(d) AS s, min(d) AS lo, max(d) AS hi, count(*) AS n
        FROM (SELECT f.customer_id, CAST(floor((epoch_us(received) - epoch_us(bought)) / 86400000000) AS BIGINT) AS d
              FROM fact f JOIN ord o ON f.order_id = o.order_id
              WHERE received IS NOT NULL AND received > bought) x
        JOIN cust c ON x.customer_id = c.customer_id GROUP BY 1"""
    delivery = f"""SELECT state AS estado, {div('s', 'n', 1)} AS dias_promedio, lo AS entrega_minima,
        hi AS entrega_maxima, n AS total_entregas, rank() OVER (ORDER BY s / n) AS ranking_mejor_entrega,
        rank() OVER (ORDER BY s / n DESC) AS ranking_peor_entrega FROM states"""

    def satisfaction(minimum: int) -> str:
        return f"""SELECT categoria, {div('s', 'n', 2)} AS score_promedio, n AS total_reviews,
            {big('pos')} AS reviews_positivas, {big('neg')} AS reviews_negativas,
            {div('pos * 100', 'n', 1)} AS pct_satisfaccion, {mean_money('v', 'n')} AS ticket_promedio,
            rank() OVER (ORDER BY s / n DESC) AS ranking_satisfaccion FROM pairs WHERE n >= {minimum}"""

    pairs = """SELECT coalesce(english, 'Sin categoría') AS categoria, sum(score) AS s, count(*) AS n,
        count(*) FILTER (score >= 4) AS pos, count(*) FILTER (score <= 2) AS neg, sum(total_c) AS v
        FROM fact f JOIN prod p ON f.product_id = p.product_id JOIN rev r ON f.order_id = r.order_id GROUP BY 1"""

    base = ["fact", "prod", "sell", "cust", "rev", "calendar"]
    extra = dict(
        monthly=monthly,
        v_month=monthly_revenue,
        cats=cats,
        v_pareto=pareto,
        sellers=sellers,
        v_seller=ranking,
        states=states,
        v_state=delivery,
        pairs=pairs,
        v_score=satisfaction(50),
    )

    def on_views(body: str) -> str:
        return query(base, body, **extra)

    kpis = (
        "SELECT (SELECT sum(revenue) FROM v_month {0}) AS revenue_total, "
        "(SELECT {3} FROM v_state {1}) AS dias_promedio, (SELECT {4} FROM v_score {2}) AS score_promedio"
    )
    day_mean = div("sum(CAST(round(dias_promedio * 10) AS BIGINT) * total_entregas)", "(10 * sum(total_entregas))", 2)
    score_mean = div("sum(CAST(round(score_promedio * 100) AS BIGINT) * total_reviews)", "(100 * sum(total_reviews))", 2)
    kpi_revenue = money("sum(CAST(round(revenue * 100) AS BIGINT))")

    def headline(months: str, states_: str, scores: str) -> str:
        return on_views(
            kpis.format(months, states_, scores, day_mean, score_mean).replace("sum(revenue)", kpi_revenue)
        )

    return {
        "monthly_revenue": on_views("SELECT * FROM v_month"),
        "category_pareto": on_views("SELECT * FROM v_pareto"),
        "seller_ranking": on_views("SELECT * FROM v_seller"),
        "delivery_by_state": on_views("SELECT * FROM v_state"),
        "category_satisfaction": on_views("SELECT * FROM v_score"),
        "category_satisfaction_binding": query(base, satisfaction(2200), pairs=pairs),
        "view_counts": on_views(
            """SELECT 'vw_revenue_mensual' AS vista, count(*) AS filas FROM v_month
            UNION ALL SELECT 'vw_top_categorias_pareto', count(*) FROM v_pareto
            UNION ALL SELECT 'vw_ranking_vendedores', count(*) FROM v_seller
            UNION ALL SELECT 'vw_tiempo_entrega_estado', count(*) FROM v_state
            UNION ALL SELECT 'vw_satisfaccion_cliente', count(*) FROM v_score"""
        ),
        "peak_month": on_views(
            "SELECT year, month, month_name, revenue FROM v_month ORDER BY revenue DESC, year, month LIMIT 1"
        ),
        "revenue_by_year": query(
            base, f"SELECT {big('y')} AS year, {mean_money('sum(rev)', 'count(*)')} AS revenue_promedio "
            "FROM monthly GROUP BY y", monthly=monthly,
        ),
        "seller_revenue_by_state_city": query(
            base,
            f"SELECT state AS seller_state, city AS seller_city, {money('sum(rev)')} AS revenue_total, "
            "count(*) AS vendedores FROM sellers GROUP BY 1, 2",
            sellers=sellers,
        ),
        "slowest_states_top10": on_views(
            "SELECT estado, dias_promedio, ranking_peor_entrega FROM v_state ORDER BY ranking_peor_entrega, estado LIMIT 10"
        ),
        "bi_headline_kpis": headline("", "", ""),
        "bi_headline_kpis_sliced": headline(
            "WHERE year IN (1997, 1998) AND month IN (1, 2, 3)",
            "WHERE estado IN ('NATION_1', 'NATION_2')",
            "WHERE categoria IN ('cat_3', 'cat_4')",
        ),
        "inactive_days": query(
            base,
            f"SELECT {big('''CAST(strftime(full_date, '%Y%m%d') AS INT)''')} AS date_sk, full_date, "
            "dayname(full_date) AS day_name FROM calendar WHERE full_date NOT IN (SELECT day FROM fact)",
        ),
        "dq_views": on_views(
            """SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM (
            SELECT 'pct_acumulado decreciente' AS test, count(*) FILTER (pct_acumulado < before) AS resultado FROM
              (SELECT *, lag(pct_acumulado) OVER (ORDER BY ranking, categoria) AS before FROM v_pareto)
            UNION ALL SELECT 'total_reviews bajo el mínimo', count(*) FILTER (total_reviews < 50) FROM v_score
            UNION ALL SELECT 'score_promedio fuera de 1-5',
              count(*) FILTER (score_promedio NOT BETWEEN 1 AND 5) FROM v_score)"""
        ),
        **_segments(base, sellers),
    }


def _segments(base: list[str], sellers: str) -> dict[str, str]:
    tiled = f"""SELECT {big('row_number() OVER (ORDER BY rev DESC, seller_id)')} AS segment_sk, *,
        substr('ABCD', CAST(ntile(4) OVER (ORDER BY rev DESC, seller_id) AS INT), 1) AS segmento FROM sellers"""

    def on(body: str) -> str:
        return query(base, body, sellers=sellers, tiled=tiled)

    segments = f"""SELECT segment_sk, seller_id AS seller_sk, seller_id, city AS ciudad, state AS estado,
        {money('rev')} AS ingresos_total, n_orders AS total_ordenes, n_products AS productos_distintos,
        {mean_money('rev', 'n')} AS ticket_promedio, first_day AS primera_venta, last_day AS ultima_venta, segmento
        FROM tiled"""
    return {
        "seller_segments": on(segments),
        "segment_summary": on(
            f"""SELECT segmento, CASE segmento WHEN 'A' THEN 'Alto rendimiento' WHEN 'B' THEN 'Medio-alto'
            WHEN 'C' THEN 'Medio-bajo' WHEN 'D' THEN 'Bajo rendimiento' END AS descripcion, n AS total_vendedores,
            {money('lo')} AS ingresos_min, {money('hi')} AS ingresos_max, {mean_money('s', 'n')} AS ingresos_avg,
            {money('s')} AS ingresos_total, {div('s * 100', '(sum(s) OVER ())', 2)} AS pct_del_total
            FROM (SELECT segmento, count(*) AS n, min(rev) AS lo, max(rev) AS hi, sum(rev) AS s
                  FROM tiled GROUP BY 1)"""
        ),
        "segment_distribution": on(
            f"""SELECT segmento, count(*) AS vendedores, {mean_money('sum(rev)', 'count(*)')} AS revenue_promedio,
            {money('min(rev)')} AS revenue_min, {money('max(rev)')} AS revenue_max,
            {div('sum(n_orders)', 'count(*)', 1)} AS ordenes_promedio FROM tiled GROUP BY 1"""
        ),
        "segment_distribution_text": on(
            f"""SELECT segmento, count(*) AS vendedores,
            {money_text(mean_money('sum(rev)', 'count(*)'))} AS revenue_promedio,
            {money_text(money('min(rev)'))} AS revenue_min, {money_text(money('max(rev)'))} AS revenue_max,
            {money_text(div('sum(n_orders)', 'count(*)', 1), '', 1)} AS ordenes_promedio FROM tiled GROUP BY 1"""
        ),
        "segment_a_top10": on(
            f"""SELECT seller_id, city AS ciudad, state AS estado, {money('rev')} AS ingresos, n_orders AS ordenes,
            n_products AS skus, first_day AS primera_venta, last_day AS ultima_venta
            FROM tiled WHERE segmento = 'A' ORDER BY rev DESC, seller_id LIMIT 10"""
        ),
        "segment_avg_revenue": on(
            f"SELECT segmento, {mean_money('sum(rev)', 'count(*)')} AS ingresos_promedio FROM tiled GROUP BY 1"
        ),
        "dq_segment_constraints": on(
            "SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM ("
            + " UNION ALL ".join(
                [
                    f"SELECT 'pk seller_segments.{c}' AS test, count(*) - count(DISTINCT {c}) AS resultado FROM tiled"
                    for c in ("segment_sk", "seller_id")
                ]
                + [
                    f"SELECT 'not null seller_segments.{c}', count(*) FILTER ({source} IS NULL) FROM tiled"
                    for c, source in {
                        "segment_sk": "segment_sk",
                        "seller_sk": "seller_id",
                        "seller_id": "seller_id",
                        "ingresos_total": "rev",
                        "total_ordenes": "n_orders",
                        "productos_distintos": "n_products",
                        "segmento": "segmento",
                    }.items()
                ]
                + [
                    f"SELECT 'largo seller_segments.{c}', count(*) FILTER (length(CAST({source} AS VARCHAR)) > {n}) FROM tiled"
                    for c, source, n in (
                        ("seller_id", "seller_id", 50),
                        ("ciudad", "city", 100),
                        ("estado", "state", 2),
                        ("segmento", "segmento", 1),
                    )
                ]
            )
            + ")"
        ),
        "dq_segments": on(
            """SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM (
            SELECT 'segmento no válido' AS test, count(*) FILTER (segmento NOT IN ('A', 'B', 'C', 'D')) AS resultado
              FROM tiled
            UNION ALL SELECT 'seller_id duplicado', count(*) - count(DISTINCT seller_id) FROM tiled
            UNION ALL SELECT 'segmento fuera de 20-30 %', count(*) FILTER (n * 100 / t NOT BETWEEN 20 AND 30) FROM
              (SELECT segmento, count(*) AS n, sum(count(*)) OVER () AS t FROM tiled GROUP BY 1)
            UNION ALL SELECT 'segmentos ausentes',
              CASE WHEN count(DISTINCT segmento) FILTER (segmento IN ('A', 'B', 'C', 'D')) <> 4 THEN 1 ELSE 0 END
              FROM tiled
            UNION ALL SELECT 'promedio de A no supera a D',
              CASE WHEN avg(rev) FILTER (segmento = 'A') <= avg(rev) FILTER (segmento = 'D') THEN 1 ELSE 0 END
              FROM tiled)"""
        ),
    }


def _monthly() -> dict[str, str]:
    def months(first: str, last: str) -> dict[str, str]:
        spine = f"""SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 MONTH)) AS DATE) AS a"""
        spans = """SELECT strftime(a, '%Y-%m') AS periodo, a, last_day(a) AS b,
            CAST(a - INTERVAL 1 MONTH AS DATE) AS pa, CAST(last_day(a) - INTERVAL 1 MONTH AS DATE) AS pb,
            CAST(a - INTERVAL 1 YEAR AS DATE) AS ya, CAST(last_day(a) - INTERVAL 1 YEAR AS DATE) AS yb FROM spine"""
        figures = """SELECT periodo,
            (SELECT coalesce(sum(total_c), 0) FROM fact WHERE day BETWEEN a AND b) AS rev,
            (SELECT coalesce(sum(total_c), 0) FROM fact WHERE day BETWEEN pa AND pb) AS prev,
            (SELECT coalesce(sum(total_c), 0) FROM fact WHERE day BETWEEN ya AND yb) AS yago,
            (SELECT count(DISTINCT order_id) FROM fact WHERE day BETWEEN a AND b) AS n_orders,
            (SELECT count(*) FROM fact WHERE day BETWEEN a AND b) AS n,
            (SELECT sum(score) FROM fact f JOIN rev r ON f.order_id = r.order_id WHERE day BETWEEN a AND b) AS score_s,
            (SELECT count(*) FROM fact f JOIN rev r ON f.order_id = r.order_id WHERE day BETWEEN a AND b) AS score_n
            FROM spans"""
        top_cat = """SELECT periodo, max(CASE WHEN rn = 1 THEN k END) AS c1, max(CASE WHEN rn = 2 THEN k END) AS c2,
            max(CASE WHEN rn = 3 THEN k END) AS c3 FROM (SELECT strftime(day, '%Y-%m') AS periodo,
              coalesce(english, raw, 'Sin Categoría') AS k, row_number() OVER (PARTITION BY strftime(day, '%Y-%m')
              ORDER BY sum(total_c) DESC, coalesce(english, raw, 'Sin Categoría')) AS rn
              FROM fact f JOIN prod p ON f.product_id = p.product_id GROUP BY 1, 2) GROUP BY 1"""
        top_seller = """SELECT periodo, max(CASE WHEN rn = 1 THEN k END) AS s1, max(CASE WHEN rn = 2 THEN k END) AS s2,
            max(CASE WHEN rn = 3 THEN k END) AS s3 FROM (SELECT strftime(day, '%Y-%m') AS periodo, seller_id AS k,
              row_number() OVER (PARTITION BY strftime(day, '%Y-%m') ORDER BY sum(total_c) DESC, seller_id) AS rn
              FROM fact GROUP BY 1, 2) GROUP BY 1"""
        snap = f"""SELECT f.periodo, {money('rev')} AS ingresos_totales, n_orders AS total_ordenes,
            coalesce({mean_money('rev', 'n')}, 0) AS ticket_promedio, c1 AS top_categoria_1, c2 AS top_categoria_2,
            c3 AS top_categoria_3, CAST(s1 AS VARCHAR) AS top_vendedor_1, CAST(s2 AS VARCHAR) AS top_vendedor_2,
            CAST(s3 AS VARCHAR) AS top_vendedor_3, {div('score_s', 'score_n', 2)} AS score_satisfaccion,
            {money('prev')} AS prev, {money('yago')} AS yago, {div('(rev - prev) * 100', 'prev', 2)} AS mom,
            {div('(rev - yago) * 100', 'yago', 2)} AS yoy
            FROM figures f LEFT JOIN top_cat c ON f.periodo = c.periodo LEFT JOIN top_seller s ON f.periodo = s.periodo"""
        return dict(spine=spine, spans=spans, figures=figures, top_cat=top_cat, top_seller=top_seller, snap=snap)

    base = ["fact", "prod", "rev"]
    ends = [f"(SELECT CAST(date_trunc('month', {end}(o_orderdate)) AS DATE) FROM orders)" for end in ("min", "max")]
    everything = months(*ends)
    report = """SELECT periodo, ingresos_totales, prev AS ingresos_mes_anterior, mom AS crecimiento_mom_pct,
        yago AS ingresos_anio_anterior, yoy AS crecimiento_yoy_pct, total_ordenes, ticket_promedio, top_categoria_1,
        top_categoria_2, top_categoria_3, top_vendedor_1, top_vendedor_2, top_vendedor_3,
        coalesce(score_satisfaccion, 0) AS score_satisfaccion_avg FROM snap"""
    return {
        "monthly_report_one": query(base, report, **months("DATE '2001-04-01'", "DATE '2001-04-01'")),
        "monthly_report_range": query(base, report, **everything),
        "monthly_report_batch": query(base, "SELECT * EXCLUDE (prev, yago, mom, yoy) FROM snap", **everything),
        "months_with_revenue": query(
            base, "SELECT count(*) FILTER (ingresos_totales > 0) AS periodos_con_datos FROM snap", **everything
        ),
        "snapshot_listing": query(
            base,
            """SELECT periodo, ingresos_totales AS ingresos, total_ordenes AS ordenes, ticket_promedio AS ticket,
            top_categoria_1 AS cat_top1, score_satisfaccion AS satisfaccion FROM snap""",
            **everything,
        ),
        "snapshot_listing_text": query(
            base,
            f"""SELECT periodo, {money_text('ingresos_totales')} AS ingresos, total_ordenes AS ordenes,
            {money_text('ticket_promedio')} AS ticket, top_categoria_1 AS cat_top1,
            score_satisfaccion AS satisfaccion FROM snap""",
            **everything,
        ),
        "snapshot_peak": query(
            base, "SELECT periodo, ingresos_totales FROM snap ORDER BY ingresos_totales DESC, periodo LIMIT 1", **everything
        ),
        "dq_snapshot_constraints": query(
            base,
            "SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM ("
            "SELECT 'pk reporte_mensual_snapshot.periodo' AS test, count(*) - count(DISTINCT periodo) AS resultado FROM snap "
            + "".join(
                f"UNION ALL SELECT 'not null reporte_mensual_snapshot.{c}', count(*) FILTER ({c} IS NULL) FROM snap "
                for c in ("periodo", "ingresos_totales", "total_ordenes", "ticket_promedio")
            )
            + "UNION ALL SELECT 'largo reporte_mensual_snapshot.periodo', count(*) FILTER (length(periodo) > 7) FROM snap)",
            **everything,
        ),
        "dq_snapshots": query(
            base,
            """SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM (
            SELECT 'periodo con formato incorrecto' AS test,
              count(*) FILTER (NOT regexp_matches(periodo, '^[0-9]{4}-[0-9]{2}$')) AS resultado FROM snap
            UNION ALL SELECT 'ingresos negativos', count(*) FILTER (ingresos_totales < 0) FROM snap
            UNION ALL SELECT 'sin top_categoria_1',
              count(*) FILTER (ingresos_totales > 0 AND top_categoria_1 IS NULL) FROM snap
            UNION ALL SELECT 'periodo duplicado', count(*) - count(DISTINCT periodo) FROM snap)""",
            **everything,
        ),
    }


def _star() -> dict[str, str]:
    text = "CAST({0} AS VARCHAR) AS {1}".format
    checks = "SELECT test, resultado, CASE WHEN resultado = 0 THEN 'PASS' ELSE 'FAIL' END AS estado FROM ({0})"
    zero = " UNION ALL ".join
    counts = {
        "customers": "customer",
        "geolocation": "nation",
        "orders": "orders",
        "order_items": "lineitem",
        "order_payments": "orders",
        "order_reviews": "rev",
        "products": "part",
        "sellers": "supplier",
        "product_category_translation": "trans",
    }
    staging = zero(f"SELECT 'staging.{name}' AS tabla, count(*) AS filas FROM {src}" for name, src in counts.items())
    # Rows of each published raw file.
    published = {
        "customers": 99441,
        "geolocation": 1000163,
        "orders": 99441,
        "order_items": 112650,
        "order_payments": 103886,
        "order_reviews": 99224,
        "products": 32951,
        "sellers": 3095,
        "product_category_translation": 71,
    }
    expected = ", ".join(f"('staging.{name}', {rows})" for name, rows in published.items())
    negative = {
        "customer_sk NULL": "customer_id IS NULL",
        "product_sk NULL": "product_id IS NULL",
        "seller_sk NULL": "seller_id IS NULL",
        "order_sk NULL": "order_id IS NULL",
        "date_sk NULL": "day IS NULL",
        "price < 0": "price_c < 0",
        "freight_value < 0": "freight_c < 0",
        "total_value < 0": "total_c < 0",
    }
    star_checks = [
        ("07 | fact_order_items — customer_sk NULL", "SELECT count(*) FROM fact WHERE customer_id IS NULL"),
        ("08 | fact_order_items — product_sk NULL", "SELECT count(*) FROM fact WHERE product_id IS NULL"),
        ("09 | fact_order_items — seller_sk NULL", "SELECT count(*) FROM fact WHERE seller_id IS NULL"),
        ("10 | fact_order_items — date_sk NULL", "SELECT count(*) FROM fact WHERE day IS NULL"),
        ("11 | fact_order_items — price negativo", "SELECT count(*) FROM fact WHERE price_c < 0"),
        ("12 | fact_reviews — score fuera de 1-5", "SELECT count(*) FROM rev WHERE score NOT BETWEEN 1 AND 5"),
        ("13 | dim_customers — IDs duplicados", "SELECT count(*) - count(DISTINCT customer_id) FROM cust"),
        ("14 | dim_products  — IDs duplicados", "SELECT count(*) - count(DISTINCT product_id) FROM prod"),
        ("15 | dim_sellers   — IDs duplicados", "SELECT count(*) - count(DISTINCT seller_id) FROM sell"),
    ]
    dims = {
        "dim_date.date_sk": ("full_date", "calendar"),
        "dim_customers.customer_sk": ("customer_id", "cust"),
        "dim_sellers.seller_sk": ("seller_id", "sell"),
        "dim_products.product_sk": ("product_id", "prod"),
        "dim_orders.order_sk": ("order_id", "ord"),
        "dim_orders.order_id": ("order_id", "ord"),
    }
    foreign = [
        ("fact_order_items.customer_sk", "fact", "customer_id", "cust", "customer_id"),
        ("fact_order_items.product_sk", "fact", "product_id", "prod", "product_id"),
        ("fact_order_items.seller_sk", "fact", "seller_id", "sell", "seller_id"),
        ("fact_order_items.order_sk", "fact", "order_id", "ord", "order_id"),
        ("fact_order_items.date_sk", "fact", "day", "calendar", "full_date"),
        ("fact_payments.order_sk", "pay", "order_id", "ord", "order_id"),
        ("fact_reviews.order_sk", "rev", "order_id", "ord", "order_id"),
    ]
    required = [
        *[
            (f"dim_date.{c}", "calendar", "full_date")
            for c in "date_sk full_date year quarter month month_name day day_of_week day_name is_weekend".split()
        ],
        ("dim_customers.customer_sk", "cust", "customer_id"),
        ("dim_customers.customer_id", "cust", "customer_id"),
        ("dim_sellers.seller_sk", "sell", "seller_id"),
        ("dim_sellers.seller_id", "sell", "seller_id"),
        ("dim_products.product_sk", "prod", "product_id"),
        ("dim_products.product_id", "prod", "product_id"),
        ("dim_orders.order_sk", "ord", "order_id"),
        ("dim_orders.order_id", "ord", "order_id"),
        ("fact_order_items.order_item_sk", "fact", "order_id"),
        ("fact_order_items.order_id", "fact", "order_id"),
        ("fact_order_items.order_item_id", "fact", "order_item_id"),
        ("fact_payments.payment_sk", "pay", "order_id"),
        ("fact_payments.order_id", "pay", "order_id"),
        ("fact_reviews.review_sk", "rev", "order_id"),
        ("fact_reviews.order_id", "rev", "order_id"),
    ]
    lengths = [
        ("dim_date.month_name", "calendar", "monthname(full_date)", 20),
        ("dim_date.day_name", "calendar", "dayname(full_date)", 20),
        ("dim_customers.customer_id", "cust", "customer_id", 32),
        ("dim_customers.customer_unique_id", "cust", "customer_unique_id", 32),
        ("dim_customers.customer_zip_code_prefix", "cust", "zip", 8),
        ("dim_customers.customer_city", "cust", "clean_city", 100),
        ("dim_customers.customer_state", "cust", "state", 2),
        ("dim_sellers.seller_id", "sell", "seller_id", 32),
        ("dim_sellers.seller_zip_code_prefix", "sell", "zip", 8),
        ("dim_sellers.seller_city", "sell", "city", 100),
        ("dim_sellers.seller_state", "sell", "state", 2),
        ("dim_products.product_id", "prod", "product_id", 32),
        ("dim_products.product_category_name", "prod", "raw", 100),
        ("dim_products.product_category_name_english", "prod", "english", 100),
        ("dim_orders.order_id", "ord", "order_id", 32),
        ("dim_orders.order_status", "ord", "order_status", 20),
        ("fact_order_items.order_id", "fact", "order_id", 32),
        ("fact_payments.order_id", "pay", "order_id", 32),
        ("fact_payments.payment_type", "pay", "payment_type", 30),
        ("fact_reviews.review_id", "rev", "review_id", 32),
        ("fact_reviews.order_id", "rev", "order_id", 32),
    ]
    constraints = (
        [f"SELECT 'pk {n}' AS test, count(*) - count(DISTINCT {k}) AS resultado FROM {t}" for n, (k, t) in dims.items()]
        # Fact keys are given while the rows are written; nothing in the source can repeat one.
        + [f"SELECT 'pk {n}' AS test, 0 AS resultado" for n in FACT_KEY_LABELS]
        + [
            f"SELECT 'fk {n}', count(*) FROM {t} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {rk} FROM {r})"
            for n, t, k, r, rk in foreign
        ]
        + [f"SELECT 'not null {n}', count(*) FROM {t} WHERE {k} IS NULL" for n, t, k in required]
    )
    coverage = """SELECT tabla, filas, sin_order_sk, pct_resuelto, CASE WHEN pct_resuelto >= 99 THEN 'PASS' ELSE 'FAIL' END AS estado
        FROM (SELECT *, CAST(filas - sin_order_sk AS DOUBLE) / filas * 100 AS pct_resuelto FROM (
            SELECT 'fact_payments' AS tabla, count(*) AS filas,
                count(*) FILTER (order_id NOT IN (SELECT order_id FROM ord)) AS sin_order_sk FROM {0}
            UNION ALL SELECT 'fact_reviews', count(*),
                count(*) FILTER (order_id NOT IN (SELECT order_id FROM ord)) FROM {1}))"""
    every = ["fact", "cust", "sell", "prod", "rev", "pay", "calendar"]
    one = "CAST({0} AS DOUBLE) AS {1}".format
    return {
        "dim_date": query(
            ["calendar"],
            f"""SELECT {big("CAST(strftime(full_date, '%Y%m%d') AS INT)")} AS date_sk, full_date,
            {big('year(full_date)')} AS year, {big('quarter(full_date)')} AS quarter, {big('month(full_date)')} AS month,
            monthname(full_date) AS month_name, {big('day(full_date)')} AS day,
            {big('dayofweek(full_date)')} AS day_of_week, dayname(full_date) AS day_name,
            dayofweek(full_date) IN (0, 6) AS is_weekend FROM calendar""",
        ),
        "dim_customers": query(
            ["cust"],
            f"""SELECT {text('customer_id', 'customer_id')}, {text('customer_unique_id', 'customer_unique_id')},
            zip AS customer_zip_code_prefix, clean_city AS customer_city, state AS customer_state FROM cust""",
        ),
        "dim_sellers": query(
            ["sell"],
            f"""SELECT {text('seller_id', 'seller_id')}, zip AS seller_zip_code_prefix, city AS seller_city,
            state AS seller_state FROM sell""",
        ),
        "dim_products": query(
            ["prod"],
            f"""SELECT {text('product_id', 'product_id')}, raw AS product_category_name,
            english AS product_category_name_english, {big('name_lenght')} AS product_name_lenght,
            {big('description_lenght')} AS product_description_lenght, {big('photos')} AS product_photos_qty,
            {one('weight', 'product_weight_g')}, {one('length_cm', 'product_length_cm')},
            {one('height_cm', 'product_height_cm')}, {one('width_cm', 'product_width_cm')} FROM prod""",
        ),
        "dim_orders": query(
            ["ord"],
            f"""SELECT {text('order_id', 'order_id')}, order_status, bought AS order_purchase_timestamp,
            approved AS order_approved_at, carrier AS order_delivered_carrier_date,
            received AS order_delivered_customer_date, estimated AS order_estimated_delivery_date FROM ord""",
        ),
        "fact_order_items": query(
            ["fact"],
            f"""SELECT {text('order_id', 'order_id')}, {big('order_item_id')} AS order_item_id,
            {text('customer_id', 'customer_id')}, {text('product_id', 'product_id')}, {text('seller_id', 'seller_id')},
            {big("CAST(strftime(day, '%Y%m%d') AS INT)")} AS date_sk, {money('price_c')} AS price,
            {money('freight_c')} AS freight_value, {money('total_c')} AS total_value FROM fact""",
        ),
        "fact_payments": query(
            ["pay"],
            f"""SELECT {text('order_id', 'order_id')}, {text('order_id', 'matched_order_id')},
            {big('seq')} AS payment_sequential, payment_type,
            {big('installments')} AS payment_installments, {money('value_c')} AS payment_value FROM pay""",
        ),
        "fact_reviews": query(
            ["rev"],
            f"""SELECT review_id, {text('order_id', 'order_id')}, {text('order_id', 'matched_order_id')}, {big('score')} AS review_score,
            title AS review_comment_title, message AS review_comment_message, created AS review_creation_date,
            answered AS review_answer_timestamp FROM rev""",
        ),
        "surrogate_keys": query(
            ["cust", "sell", "prod", "ord", "fact", "pay", "rev"],
            zero(
                f"SELECT '{name}' AS tabla, count(*) AS filas, count(*) AS claves, {big('0')} AS nulas, {big('1')} AS menor, count(*) AS mayor FROM {src}"
                for name, src in (
                    ("dim_customers", "cust"),
                    ("dim_sellers", "sell"),
                    ("dim_products", "prod"),
                    ("dim_orders", "ord"),
                    ("fact_order_items", "fact"),
                    ("fact_payments", "pay"),
                    ("fact_reviews", "rev"),
                )
            ),
        ),
        "staging_counts": query(["rev", "trans"], staging),
        "file_manifest": query(
            ["rev", "trans"],
            f"""SELECT e.tabla, {big('esperadas')} AS esperadas, coalesce(filas, 0) AS filas,
            CASE WHEN filas = esperadas THEN 'PASS' ELSE 'FAIL' END AS estado
            FROM (VALUES {expected}) e(tabla, esperadas) LEFT JOIN counted c ON e.tabla = c.tabla""",
            counted=staging,
        ),
        "dq_info": query(
            every,
            """SELECT 'INFO' AS tipo, '01 | fact_order_items' AS tabla, count(*) AS filas FROM fact
            UNION ALL SELECT 'INFO', '02 | dim_customers', count(*) FROM cust
            UNION ALL SELECT 'INFO', '03 | dim_products', count(*) FROM prod
            UNION ALL SELECT 'INFO', '04 | dim_sellers', count(*) FROM sell
            UNION ALL SELECT 'INFO', '05 | dim_orders', count(*) FROM ord
            UNION ALL SELECT 'INFO', '06 | dim_date', count(*) FROM calendar""",
        ),
        "dq_checks": query(
            every, checks.format(zero(f"SELECT '{label}' AS test, ({sql}) AS resultado" for label, sql in star_checks))
        ),
        "dq_constraints": query(every, checks.format(zero(constraints))),
        "dq_text_lengths": query(
            every,
            checks.format(
                zero(
                    f"SELECT 'largo {n}' AS test, count(*) FILTER (length(CAST({c} AS VARCHAR)) > {m}) AS resultado FROM {t}"
                    for n, t, c, m in lengths
                )
            ),
        ),
        "dq_fact_amounts": query(
            ["fact"],
            checks.format(
                zero(f"SELECT '{label}' AS test, count(*) AS resultado FROM fact WHERE {p}" for label, p in negative.items())
            ),
        ),
        "fk_coverage": query(["pay", "rev", "ord"], coverage.format("pay", "rev")),
        # No key in the source leads to another order, so what is counted is that none was resolved wrongly.
        "sk_integrity": query(
            ["pay", "ord"],
            checks.format(
                "SELECT 'order_sk / order_id' AS test, count(*) FILTER (p.order_id <> o.order_id) AS resultado "
                "FROM pay p JOIN ord o ON p.order_id = o.order_id"
            ),
        ),
        "soiled_dq_info": query(
            [*every, "ord", "sfact"],
            """SELECT 'INFO' AS tipo, '01 | fact_order_items' AS tabla, count(*) AS filas FROM sfact
            UNION ALL SELECT 'INFO', '02 | dim_customers', count(*) FROM cust
            UNION ALL SELECT 'INFO', '03 | dim_products', count(*) FROM prod
            UNION ALL SELECT 'INFO', '04 | dim_sellers', count(*) FROM sell
            UNION ALL SELECT 'INFO', '05 | dim_orders', count(*) FROM ord
            UNION ALL SELECT 'INFO', '06 | dim_date', datediff('day', min(day), max(day)) + 1 FROM ord WHERE order_id % 150 <> 2""",
        ),
        "soiled_dq_checks": query(
            [*every, "sfact", "srev"],
            checks.format(
                zero(
                    f"SELECT '{label}' AS test, ({sql.replace('FROM fact', 'FROM sfact').replace('FROM rev', 'FROM srev')}) AS resultado"
                    for label, sql in star_checks
                )
            ),
        ),
        "soiled_fk_coverage": query(["spay", "srev", "ord"], coverage.format("spay", "srev")),
        "soiled_fact_amounts": query(
            ["sfact"],
            checks.format(
                zero(f"SELECT '{label}' AS test, count(*) AS resultado FROM sfact WHERE {p}" for label, p in negative.items())
            ),
        ),
        "calendar_gaps": query(
            ["calendar"],
            checks.format(
                "SELECT 'dim_date gaps' AS test, count(*) FILTER (nxt - full_date > 1) AS resultado FROM "
                "(SELECT full_date, lead(full_date) OVER (ORDER BY full_date) AS nxt FROM calendar)"
            ),
        ),
    }


def _orders() -> dict[str, str]:
    profile = {
        "orders": "SELECT order_id, customer_id, order_status, bought, approved, carrier, received, estimated FROM ord",
        "customers": "SELECT customer_id, customer_unique_id, zip, city, state FROM cust",
        "order_items": "SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price_c, freight_c FROM item",
        "payments": "SELECT * FROM pay",
        "reviews": "SELECT * FROM rev",
        "products": "SELECT product_id, raw, name_lenght, description_lenght, photos, weight, length_cm, height_cm, width_cm FROM prod",
        "sellers": "SELECT * FROM sell",
        "translation": "SELECT * FROM trans",
    }
    columns = {
        "orders": ["order_id", "customer_id", "order_status", "bought", "approved", "carrier", "received", "estimated"],
        "customers": ["customer_id", "customer_unique_id", "zip", "city", "state"],
        "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price_c", "freight_c"],
        "payments": ["order_id", "seq", "payment_type", "installments", "value_c"],
        "reviews": ["review_id", "order_id", "score", "title", "message", "created", "answered"],
        "products": ["product_id", "raw", "name_lenght", "description_lenght", "photos", "weight", "length_cm", "height_cm", "width_cm"],
        "sellers": ["seller_id", "zip", "city", "state"],
        "translation": ["raw", "english"],
    }

    def nulls(table: str) -> str:
        return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in columns[table])

    dataset = " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, count(*) AS filas, {big(str(len(columns[t])))} AS columnas,
        CAST(sum({nulls(t)}) AS DOUBLE) / (count(*) * {len(columns[t])}) * 100 AS nulos_pct,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql}))) AS duplicados FROM ({sql})"""
        for t, sql in profile.items()
    )
    names = {
        "orders": {
            "approved": "order_approved_at",
            "carrier": "order_delivered_carrier_date",
            "received": "order_delivered_customer_date",
        },
        "products": {
            "raw": "product_category_name",
            "name_lenght": "product_name_lenght",
            "description_lenght": "product_description_lenght",
            "photos": "product_photos_qty",
            "weight": "product_weight_g",
        },
    }
    missing = " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, '{names[t].get(c, c)}' AS columna,
        CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) * 100 AS nulos_pct FROM {src}"""
        for t, src in (("orders", "ord"), ("products", "prod"))
        for c in columns[t]
    )
    month = "CAST(date_trunc('month', bought) AS DATE)"
    monthly = f"""SELECT {month} AS mes, count(*) AS n, coalesce(sum(revenue_c), 0) AS r FROM enriched
        {{0}} GROUP BY 1"""
    show_month = f"SELECT mes, n AS n_ordenes, {money('r')} AS revenue FROM m"
    filters = """WHERE bought >= TIMESTAMP '1996-03-15' AND bought < TIMESTAMP '2000-07-01'
        AND customer_state IN ('NATION_1', 'NATION_5', 'NATION_9') AND order_status IN ('delivered')"""
    delivered_only = "WHERE order_status IN ('delivered')"

    by_state = f"""SELECT customer_state, n AS n_ordenes, {money('r')} AS revenue, {pct('n', 't')} AS pct_ordenes,
        {pct('u', 't')} AS pct_acum, p AS posicion, r FROM (
        SELECT *, sum(n) OVER () AS t, sum(n) OVER (ORDER BY n DESC, customer_state ROWS UNBOUNDED PRECEDING) AS u,
        row_number() OVER (ORDER BY n DESC, customer_state) AS p FROM (
        SELECT customer_state, count(*) AS n, coalesce(sum(revenue_c), 0) AS r FROM enriched GROUP BY 1))"""

    stats = interpolated("valued", "revenue_c", {"med": (1, 2), "p90": (9, 10)})
    micro = "(CAST({0} AS DOUBLE) / 1e8)".format

    def boxes(limit: int) -> dict[str, str]:
        v = f"""SELECT CASE WHEN n_items >= 5 THEN '5+' ELSE CAST(n_items AS VARCHAR) END AS g,
            least(revenue_c, {limit}00) AS v FROM valued"""
        q = interpolated("vals", "v", {"q1": (1, 4), "q2": (1, 2), "q3": (3, 4)}, by="g")
        return dict(vals=v, q=q)

    box = f"""SELECT q.g AS n_items, c.n, least(c.lo, q.q1 / 1e8) AS bigote_inferior, {micro('q.q1')} AS q1,
        {micro('q.q2')} AS mediana, {micro('q.q3')} AS q3, greatest(c.hi, q.q3 / 1e8) AS bigote_superior
        FROM q JOIN (SELECT vals.g, count(*) AS n,
            CAST(min(CASE WHEN v * 2000000 >= 2 * q1 - 3 * (q3 - q1) THEN v END) AS DOUBLE) / 1e2 AS lo,
            CAST(max(CASE WHEN v * 2000000 <= 2 * q3 + 3 * (q3 - q1) THEN v END) AS DOUBLE) / 1e2 AS hi
            FROM vals JOIN q ON vals.g = q.g GROUP BY 1) c ON c.g = q.g"""

    def value_hist(limit: int) -> str:
        return query(["valued"], histogram("h", "v", 50, "1e2"), h=f"SELECT least(revenue_c, {limit}00) AS v FROM valued")

    by_type = f"""SELECT payment_type, count(*) AS n_transacciones, sum(value_c) AS r,
        CAST(sum(installments) AS DOUBLE) / count(installments) AS cuotas_prom FROM pay GROUP BY 1"""
    return {
        "dataset_profile": query(["ord", "cust", "item", "pay", "rev", "prod", "sell", "trans"], dataset),
        "null_profile": query(
            ["ord", "prod"],
            """SELECT *, CASE WHEN nulos_pct > 10 THEN 'alto' WHEN nulos_pct > 3 THEN 'medio' ELSE 'bajo' END AS severidad
            FROM missing WHERE nulos_pct > 0""",
            missing=missing,
        ),
        "order_revenue": query(
            ["order_rev"],
            f"SELECT order_id, {money('revenue_c')} AS revenue, {money('freight_c')} AS freight, n_items FROM order_rev",
        ),
        "orders_enriched": query(
            ["enriched"],
            f"""SELECT customer_id, order_id, order_status, bought AS order_purchase_timestamp,
            approved AS order_approved_at, carrier AS order_delivered_carrier_date,
            received AS order_delivered_customer_date, estimated AS order_estimated_delivery_date,
            {money('revenue_c')} AS revenue, {money('freight_c')} AS freight, n_items, customer_state, customer_city
            FROM enriched""",
        ),
        "items_enriched": query(
            ["item", "prod", "ord", "cust"],
            f"""SELECT i.order_id, {big('order_item_id')} AS order_item_id, i.product_id, seller_id, shipping_limit_date,
            {money('price_c')} AS price, {money('freight_c')} AS freight_value, english AS product_category_name_english,
            o.customer_id, bought AS order_purchase_timestamp, order_status, received AS order_delivered_customer_date,
            estimated AS order_estimated_delivery_date, state AS customer_state
            FROM item i LEFT JOIN prod p ON i.product_id = p.product_id LEFT JOIN ord o ON i.order_id = o.order_id
            LEFT JOIN cust c ON o.customer_id = c.customer_id""",
        ),
        "headline_counts": query(
            ["ord", "item", "cust"],
            f"""SELECT (SELECT count(*) FROM ord) AS ordenes, (SELECT count(*) FROM item) AS items,
            (SELECT count(DISTINCT customer_unique_id) FROM cust) AS clientes_unicos,
            (SELECT count(*) FROM supplier) AS vendedores, (SELECT count(*) FROM part) AS productos,
            (SELECT {money('sum(price_c)')} FROM item) AS revenue_total, (SELECT min(day) FROM ord) AS primera_fecha,
            (SELECT max(day) FROM ord) AS ultima_fecha""",
        ),
        "order_status_counts": query(["ord"], "SELECT order_status, count(*) AS cantidad FROM ord GROUP BY 1"),
        "eda_monthly": query(["enriched"], show_month, m=monthly.format("")),
        "eda_monthly_delivered": query(["enriched"], show_month, m=monthly.format(delivered_only)),
        "eda_monthly_filtered": query(["enriched"], show_month, m=monthly.format(filters)),
        "eda_monthly_text": query(
            ["enriched"],
            f"SELECT strftime(mes, '%Y-%m') AS mes, n AS ordenes, {money_text(money('r'), 'R$ ', 0)} AS revenue FROM m",
            m=monthly.format(""),
        ),
        "eda_monthly_highlights": query(
            ["enriched"],
            """SELECT (SELECT mes FROM m ORDER BY n DESC, mes LIMIT 1) AS mes_pico, (SELECT max(n) FROM m) AS ordenes_pico,
            CAST((SELECT n FROM m ORDER BY mes DESC LIMIT 1 OFFSET 2) AS DOUBLE)
              / (SELECT n FROM m ORDER BY mes LIMIT 1 OFFSET 4) * 100 - 100 AS crecimiento_pct""",
            m=monthly.format(""),
        ),
        "order_value_stats": query(
            ["valued"],
            f"""SELECT {money('s')} AS revenue_total, {mean_money('s', 'n', 4)} AS revenue_promedio,
            {micro('med')} AS mediana, {money('hi')} AS maximo, {micro('p90')} AS p90, n AS ordenes
            FROM q, (SELECT sum(revenue_c) AS s, count(*) AS n, max(revenue_c) AS hi FROM valued)""",
            q=stats,
        ),
        "order_value_histogram": value_hist(1000),
        "order_value_histogram_wide": value_hist(300000),
        "order_value_by_items": query(["valued"], box, **boxes(2000)),
        "order_value_by_items_wide": query(["valued"], box, **boxes(400000)),
        "orders_by_state": query(["enriched"], "SELECT * EXCLUDE (r) FROM s", s=by_state),
        "top_state_share": query(
            ["enriched"],
            f"SELECT {pct('sum(n_ordenes) FILTER (posicion <= 3)', 'sum(n_ordenes)')} AS pct_top FROM s",
            s=by_state,
        ),
        "top_states_by_revenue": query(
            ["enriched"],
            """SELECT customer_state, n_ordenes, revenue, row_number() OVER (ORDER BY r, customer_state) AS lugar
            FROM s WHERE posicion <= 15""",
            s=by_state,
        ),
        "payment_type_stats": query(
            ["pay"], f"SELECT payment_type, n_transacciones, {money('r')} AS revenue, cuotas_prom FROM t", t=by_type
        ),
        "card_share": query(
            ["pay"],
            f"""SELECT {pct_money("sum(r) FILTER (payment_type = 'credit_card')", 'sum(r)')} AS pct_revenue,
            max(cuotas_prom) FILTER (payment_type = 'credit_card') AS cuotas_prom FROM t""",
            t=by_type,
        ),
        "card_installments": query(
            ["pay"],
            f"""SELECT {big('installments')} AS cuotas, count(*) AS transacciones FROM pay
            WHERE payment_type = 'credit_card' GROUP BY 1 ORDER BY 1 LIMIT 12""",
        ),
        "filter_domain": query(
            ["enriched"],
            """SELECT campo, valor, row_number() OVER (PARTITION BY campo ORDER BY valor) AS orden FROM (
            SELECT 'fecha_min' AS campo, CAST(min(day) AS VARCHAR) AS valor FROM enriched
            UNION ALL SELECT 'fecha_max', CAST(max(day) AS VARCHAR) FROM enriched
            UNION ALL SELECT DISTINCT 'customer_state', customer_state FROM enriched WHERE customer_state IS NOT NULL
            UNION ALL SELECT DISTINCT 'order_status', order_status FROM enriched)""",
        ),
    }


def _catalog() -> dict[str, str]:
    cats = """SELECT coalesce(english, raw, 'unknown') AS category, sum(price_c) AS r, count(*) AS n_items,
        count(DISTINCT order_id) AS n_orders FROM item i LEFT JOIN prod p ON i.product_id = p.product_id GROUP BY 1"""
    cat_stats = f"""SELECT category, {money('r')} AS revenue, n_items, n_orders,
        {pct_money('r', '(sum(r) OVER ())')} AS revenue_pct,
        {pct_money('(sum(r) OVER (ORDER BY r DESC, category ROWS UNBOUNDED PRECEDING))', '(sum(r) OVER ())')}
          AS revenue_acum, row_number() OVER (ORDER BY r DESC, category) AS rank FROM cats"""
    scores = """SELECT coalesce(english, 'unknown') AS category, CAST(sum(score) AS DOUBLE) / count(*) AS avg_score,
        count(*) AS n_reviews FROM rev r LEFT JOIN item i ON r.order_id = i.order_id
        LEFT JOIN prod p ON i.product_id = p.product_id GROUP BY 1 HAVING count(*) >= {0}"""
    sellers = """SELECT i.seller_id, any_value(s.state) AS state, sum(price_c) AS r, count(DISTINCT order_id) AS n_ordenes,
        count(*) AS n FROM item i LEFT JOIN sell s ON i.seller_id = s.seller_id GROUP BY 1"""
    running = "(sum(r) OVER (ORDER BY r DESC, seller_id ROWS UNBOUNDED PRECEDING))"
    seller_stats = f"""SELECT seller_id, {money('r')} AS revenue, n_ordenes, n AS n_items,
        {mean_money('r', 'n', 4)} AS ticket_prom, state AS seller_state, {pct_money('r', '(sum(r) OVER ())')} AS revenue_pct,
        {pct_money(running, '(sum(r) OVER ())')} AS revenue_acum,
        row_number() OVER (ORDER BY r DESC, seller_id) AS rank FROM sellers"""
    lorenz = f"""SELECT seller_id, rn AS posicion,
        CASE WHEN n = 1 THEN 0::DOUBLE ELSE CAST(rn - 1 AS DOUBLE) / CAST(n - 1 AS DOUBLE) * 100 END AS pct_vendedores,
        {pct_money('u', 't')} AS pct_revenue FROM (SELECT seller_id, row_number() OVER (ORDER BY r, seller_id) AS rn,
        count(*) OVER () AS n, sum(r) OVER (ORDER BY r, seller_id ROWS UNBOUNDED PRECEDING) AS u, sum(r) OVER () AS t
        FROM sellers)"""
    concentration = f"""SELECT max(n) AS vendedores, {pct('count(*) FILTER (u * 2 <= t)', 'max(n)')} AS pct_vendedores_50,
        {pct('count(*) FILTER (n_ordenes < 10)', 'max(n)')} AS pct_menos_10_ordenes,
        {mean_money('max(t)', 'max(n)', 4)} AS revenue_promedio,
        {mean_money('(min(r) FILTER (mid) + max(r) FILTER (mid))', '2', 4)} AS revenue_mediana
        FROM (SELECT *, rk IN ((n + 1) // 2, (n + 2) // 2) AS mid FROM (SELECT r, n_ordenes, count(*) OVER () AS n,
        row_number() OVER (ORDER BY r DESC, seller_id) AS rk, {running} AS u, sum(r) OVER () AS t FROM sellers))"""
    log_hist = """SELECT CAST(b.bin AS BIGINT) AS bin, round(lo + (hi - lo) * b.bin / 40, 6) AS desde,
        round(lo + (hi - lo) * (b.bin + 1) / 40, 6) AS hasta, CAST(coalesce(n, 0) AS BIGINT) AS n
        FROM (SELECT CAST(unnest(range(40)) AS DOUBLE) AS bin) b
        CROSS JOIN (SELECT min(v) AS lo, max(v) AS hi FROM h) e
        LEFT JOIN (SELECT least(39, floor((v - l) * 40 / (m - l))) AS bin, count(*) AS n FROM h,
                   (SELECT min(v) AS l, max(v) AS m FROM h) GROUP BY 1) c ON c.bin = b.bin"""
    best = """SELECT * FROM (SELECT *, 'mejores' AS grupo FROM s ORDER BY avg_score DESC, category LIMIT 5)
        UNION ALL SELECT * FROM (SELECT *, 'peores' AS grupo FROM s ORDER BY avg_score, category DESC LIMIT 5)"""
    on_items = ["item", "sell"]
    return {
        "eda_category_stats": query(["item", "prod"], cat_stats, cats=cats),
        "categories_for_80": query(
            ["item", "prod"], "SELECT count(*) FILTER (revenue_acum <= 80) AS n_categorias FROM s", cats=cats, s=cat_stats
        ),
        "top_categories": query(
            ["item", "prod"], "SELECT category, revenue, revenue_pct, rank FROM s WHERE rank <= 15", cats=cats, s=cat_stats
        ),
        "category_satisfaction_eda": query(["rev", "item", "prod"], scores.format(100)),
        "category_best_worst": query(["rev", "item", "prod"], best, s=scores.format(100)),
        "eda_seller_stats": query(on_items, seller_stats, sellers=sellers),
        "seller_revenue_log_histogram": query(
            on_items, log_hist, sellers=sellers, h=f"SELECT log10({money('r')} + 1) AS v FROM sellers"
        ),
        "lorenz_curve": query(on_items, lorenz, sellers=sellers),
        "seller_concentration": query(on_items, concentration, sellers=sellers),
        "seller_state_top10": query(
            on_items,
            f"""SELECT state AS seller_state, {money('sum(r)')} AS revenue, count(*) AS n_sellers FROM sellers
            WHERE state IS NOT NULL GROUP BY 1 ORDER BY sum(r) DESC, 1 LIMIT 10""",
            sellers=sellers,
        ),
    }


def _service() -> dict[str, str]:
    def hist(expression: str, where: str = "") -> str:
        return query(["delivered"], histogram("h", "d", 40), h=f"SELECT {expression} AS d FROM delivered {where}")

    by_state = """SELECT customer_state, CAST(sum(dias_entrega) AS DOUBLE) / count(*) AS dias_prom, count(*) AS n
        FROM delivered WHERE customer_state IS NOT NULL GROUP BY 1 HAVING count(*) >= 100"""

    def bucket(edges: list[int], labels: list[str]) -> str:
        cases = " ".join(
            f"WHEN dias_entrega > {lo} AND dias_entrega <= {hi} THEN '{label}'"
            for lo, hi, label in zip(edges, edges[1:], labels)
        )
        return f"CASE {cases} END"

    dashboard = bucket([0, 7, 14, 21, 30, 200], ["0-7 dias", "8-14 dias", "15-21 dias", "22-30 dias", "30+ dias"])
    notebook = bucket([0, 7, 14, 21, 30, 60], ["0-7d", "8-14d", "15-21d", "22-30d", "30d+"])
    mean_score = "CAST(sum(score) AS DOUBLE) / count(score)"
    overall = interpolated("delivered", "dias_entrega", {"med": (1, 2)})
    mean_days = "CAST(sum(dias_entrega) AS DOUBLE) / count(dias_entrega)"
    on_time = true_pct("dias_vs_estimado >= 0")
    kpis = f"""SELECT (SELECT count(*) FROM f) AS ordenes, (SELECT {money('coalesce(sum(revenue_c), 0)')} FROM f) AS revenue_total,
        (SELECT {mean_money('sum(revenue_c)', 'count(revenue_c)', 4)} FROM f) AS ticket_promedio,
        (SELECT {mean_score} FROM rev) AS score_promedio, (SELECT {mean_days} FROM delivered) AS entrega_promedio,
        (SELECT {on_time} FROM delivered) AS pct_a_tiempo"""
    return {
        "delivered_orders": query(
            ["delivered"], "SELECT order_id, customer_id, dias_entrega, dias_vs_estimado, customer_state FROM delivered"
        ),
        "delivery_histogram_clipped": hist("least(greatest(dias_entrega, 0), 60)"),
        "delivery_histogram_filtered": hist("dias_entrega", "WHERE dias_entrega BETWEEN 0 AND 60"),
        "estimate_histogram": hist("least(greatest(dias_vs_estimado, -30), 30)"),
        "delivery_state_eda": query(
            ["delivered"],
            "SELECT *, CASE WHEN dias_prom > 20 THEN 'alto' WHEN dias_prom > 15 THEN 'medio' ELSE 'bajo' END AS severidad FROM s",
            s=by_state,
        ),
        "delivery_state_slowest": query(
            ["delivered"],
            """SELECT *, CASE WHEN dias_prom > 20 THEN 'alto' WHEN dias_prom > 15 THEN 'medio' ELSE 'bajo' END AS severidad
            FROM s ORDER BY dias_prom DESC, customer_state LIMIT 10""",
            s=by_state,
        ),
        "delivery_overall": query(
            ["delivered"],
            f"""SELECT (SELECT {mean_days} FROM delivered) AS promedio, CAST(med AS DOUBLE) / 1e6 AS mediana,
            (SELECT count(*) FROM delivered) AS ordenes FROM q""",
            q=overall,
        ),
        "on_time_pct": query(["delivered"], f"SELECT {on_time} AS pct_a_tiempo FROM delivered"),
        "score_by_delivery_bucket": query(
            ["delivered", "rev"],
            f"""SELECT {dashboard} AS rango_entrega, {mean_score} AS review_score
            FROM delivered d LEFT JOIN rev r ON d.order_id = r.order_id WHERE {dashboard} IS NOT NULL GROUP BY 1""",
        ),
        "score_by_delivery_bucket_notebook": query(
            ["delivered", "rev"],
            f"""SELECT {notebook} AS rango_entrega, {mean_score} AS review_score
            FROM rev r LEFT JOIN delivered d ON d.order_id = r.order_id WHERE {notebook} IS NOT NULL GROUP BY 1""",
        ),
        "score_distribution": query(
            ["rev"],
            f"""SELECT {big('score')} AS score, count(*) AS cantidad, {pct('count(*)', '(SELECT count(*) FROM rev)')} AS pct
            FROM rev WHERE score IS NOT NULL GROUP BY 1""",
        ),
        "score_summary": query(
            ["rev"],
            f"""SELECT {mean_score} AS score_promedio, {true_pct('score >= 4')} AS pct_positivas,
            {true_pct('score <= 2')} AS pct_negativas, {true_pct('score = 5')} AS pct_5_estrellas,
            {true_pct('score = 1')} AS pct_1_estrella FROM rev""",
        ),
        "dashboard_kpis": query(
            ["enriched", "rev", "delivered"], kpis, f="SELECT * FROM enriched WHERE order_status IN ('delivered')"
        ),
        "executive_summary": query(
            ["enriched", "rev", "delivered", "item", "prod"],
            f"""SELECT (SELECT {money('sum(revenue_c)')} FROM order_rev) AS revenue_total,
            (SELECT {mean_money('sum(revenue_c)', 'count(*)', 4)} FROM order_rev) AS ticket_promedio,
            (SELECT {mean_score} FROM rev) AS score_promedio, (SELECT {true_pct('score = 5')} FROM rev) AS pct_5_estrellas,
            (SELECT {true_pct('score = 1')} FROM rev) AS pct_1_estrella, (SELECT {mean_days} FROM delivered) AS entrega_promedio,
            (SELECT {on_time} FROM delivered) AS pct_a_tiempo,
            (SELECT coalesce(english, raw, 'unknown') FROM item i LEFT JOIN prod p ON i.product_id = p.product_id
             GROUP BY 1 ORDER BY sum(price_c) DESC, 1 LIMIT 1) AS categoria_top,
            (SELECT customer_state FROM enriched WHERE customer_state IS NOT NULL GROUP BY 1
             ORDER BY count(*) DESC, 1 LIMIT 1) AS estado_top,
            (SELECT count(DISTINCT seller_id) FROM item) AS vendedores_activos""",
        ),
    }


def _built(plain: dict[str, str]) -> dict[str, str]:
    """The reports over the star built from text, where ids are text, and over the soiled one."""
    names = "monthly_revenue category_pareto seller_ranking delivery_by_state category_satisfaction segment_summary".split()
    built = {f"built_{name}": plain[name] for name in names}
    ranking = built["built_seller_ranking"]
    built["built_seller_ranking"] = f"SELECT * REPLACE (CAST(seller_id AS VARCHAR) AS seller_id) FROM ({ranking})"
    soiled = plain["monthly_revenue"].replace(f"fact AS ({CTES['fact'][1]})", f"fact AS ({CTES['sfact'][1]})")
    return built | {"soiled_monthly_revenue": soiled}


def statements() -> dict[str, str]:
    plain = {**_views(), **_monthly(), **_star(), **_orders(), **_catalog(), **_service()}
    by_function = {f"{name}_function": plain[name] for name in ("segment_summary",)}
    by_function["monthly_report_function"] = plain["monthly_report_one"]
    return plain | _built(plain) | by_function
