"""The thirty reports on the star-schema test data."""

from __future__ import annotations

from ..plans import customers, delivery, ranking, running, trend
from .registry import query

# Report parameters on the test data.
TIE_CATEGORY = "Brand#3"
GAP = {"before": "1995-09-01", "missing_month": "1995-03-01"}
WINDOW = {"first": "1995-01-01", "last": "2001-07-01"}
STATES = [f"NATION_{i}" for i in range(6)]


@query("r01_ranking_functions", """
    with units as (
        select product_id, count(*) as n, sum(price) as revenue
        from v_sold where product_id in (select product_id from v_products where product_category_name = 'Brand#3')
        group by product_id)
    select left(cast(product_id as varchar), 8) as product, n as units_sold,
           round(cast(revenue as double), 2) as revenue_brl,
           row_number() over (order by n desc, product_id) as row_number,
           rank() over (order by n desc) as rank, dense_rank() over (order by n desc) as dense_rank
    from units qualify row_number() over (order by n desc, product_id) <= 8""")
def r01(t):
    return ranking.ranking_functions(t, TIE_CATEGORY)


@query("r02_top_products_per_category", """
    with p as (
        select l.category, s.product_id, sum(s.price) as revenue, count(*) as units
        from v_sold s join v_labelled l using (product_id) where l.category is not null group by all),
    c as (select category, sum(revenue) as total from p group by category order by total desc, category limit 6)
    select p.category, dense_rank() over (partition by p.category order by p.revenue desc) as revenue_rank,
           left(cast(p.product_id as varchar), 8) as product, round(cast(p.revenue as double), 2) as revenue_brl,
           p.units as units_sold, round(100.0 * cast(p.revenue as double) / cast(c.total as double), 1) as pct_of_category
    from p join c using (category)
    qualify dense_rank() over (partition by p.category order by p.revenue desc) <= 5""")
def r02(t):
    return ranking.top_products_per_category(t)


@query("r03_top_sellers_per_state", """
    with s as (
        select v.seller_state, x.seller_id, sum(x.price) as revenue, count(distinct x.order_id) as orders
        from v_sold x join v_sellers v using (seller_id) group by all),
    big as (select seller_state, sum(revenue) as total from s group by 1 order by 2 desc, 1 limit 10)
    select s.seller_state, rank() over (partition by s.seller_state order by s.revenue desc) as state_rank,
           left(cast(s.seller_id as varchar), 8) as seller, round(cast(s.revenue as double), 2) as revenue_brl, s.orders,
           round(100.0 * cast(s.revenue as double) / cast(big.total as double), 1) as pct_of_state
    from s join big using (seller_state)
    qualify rank() over (partition by s.seller_state order by s.revenue desc) <= 3""")
def r03(t):
    return ranking.top_sellers_per_state(t)


@query("r04_leading_category_per_state", """
    with sc as (
        select c.customer_state, l.category, sum(s.price) as revenue
        from v_sold s join v_customers c using (customer_id) join v_labelled l using (product_id)
        where l.category is not null group by all)
    select customer_state, category as top_category, round(cast(revenue as double), 2) as category_revenue_brl,
           round(cast(total as double), 2) as state_revenue_brl,
           round(100.0 * cast(revenue as double) / cast(total as double), 1) as pct_of_state
    from (select sc.*, sum(revenue) over (partition by customer_state) as total,
                 row_number() over (partition by customer_state order by revenue desc, category) as place from sc)
    where place = 1 order by total desc, customer_state limit 12""")
def r04(t):
    return ranking.leading_category_per_state(t)


@query("r05_seller_deciles", """
    with s as (select seller_id, sum(price) as revenue from v_sold group by seller_id),
    d as (select revenue, ntile(10) over (order by revenue desc, seller_id) as decile from s),
    g as (select decile, count(*) as n, sum(revenue) as revenue from d group by decile)
    select decile as revenue_decile, n as sellers, round(cast(revenue as double), 2) as decile_revenue_brl,
           round(100.0 * cast(revenue as double) / cast(sum(revenue) over () as double), 1) as pct_of_total_revenue,
           round(100.0 * cast(sum(revenue) over (order by decile) as double) / cast(sum(revenue) over () as double), 1) as cumulative_pct,
           round(cast(revenue as double) / n, 2) as avg_seller_revenue_brl
    from g""")
def r05(t):
    return ranking.seller_deciles(t)


# Early months with one month taken out, sparse and dense.
EARLY_MONTHS = """
    with sparse as (
        select cast(date_trunc('month', bought_at) as date) as month, sum(price) as revenue
        from v_sold
        where bought_at < timestamp '1995-09-01' and not (year(bought_at) = 1995 and month(bought_at) = 3)
        group by 1)"""


@query("r06_lag_with_and_without_spine", EARLY_MONTHS + """,
    naive as (select month, revenue, lag(month) over (order by month) as pm, lag(revenue) over (order by month) as pr from sparse),
    dense as (
        select cast(g.m as date) as month, coalesce(s.revenue, 0) as revenue
        from generate_series(timestamp '1995-01-01', timestamp '1995-08-01', interval 1 month) g(m)
        left join sparse s on s.month = cast(g.m as date)),
    lagged as (select month, revenue, lag(revenue) over (order by month) as pr from dense)
    select strftime(l.month, '%Y-%m') as month, round(cast(l.revenue as double), 2) as revenue_brl,
           strftime(n.pm, '%Y-%m') as naive_prev_month,
           round(100.0 * cast(n.revenue - n.pr as double) / nullif(cast(n.pr as double), 0), 1) as naive_mom_pct,
           round(100.0 * cast(l.revenue - l.pr as double) / nullif(cast(l.pr as double), 0), 1) as spine_mom_pct
    from lagged l left join naive n on n.month = l.month""")
def r06(t):
    return trend.lag_with_and_without_spine(t, first="1995-01-01", last="1995-08-01", **GAP)


# The dense series over the analysis window.
SERIES = """
    with series as (
        select cast(g.m as date) as month, coalesce(v.revenue, 0) as revenue, coalesce(v.orders, 0) as orders
        from generate_series(timestamp '1995-01-01', timestamp '2001-07-01', interval 1 month) g(m)
        left join v_monthly v on v.month = cast(g.m as date))"""


@query("r07_month_over_month", SERIES + """,
    x as (select *, lag(revenue) over (order by month) as pr from series)
    select strftime(month, '%Y-%m') as month, round(cast(revenue as double), 2) as revenue_brl, orders,
           round(cast(revenue as double) / nullif(cast(orders as double), 0), 2) as avg_order_value_brl,
           round(cast(pr as double), 2) as prev_month_brl,
           round(100.0 * cast(revenue - pr as double) / nullif(cast(pr as double), 0), 1) as mom_growth_pct
    from x""")
def r07(t):
    return trend.month_over_month(t, **WINDOW)


@query("r08_rows_against_range", EARLY_MONTHS + """
    select strftime(month, '%Y-%m') as month, round(cast(revenue as double), 2) as revenue_brl,
           round(cast(sum(revenue) over r as double) / count(*) over r, 2) as ma_3mo_rows,
           round(cast(sum(revenue) over v as double) / count(*) over v, 2) as ma_3mo_range,
           count(*) over r as rows_in_frame, count(*) over v as range_in_frame
    from sparse
    window r as (order by month rows between 2 preceding and current row),
           v as (order by month range between interval 2 month preceding and current row)""")
def r08(t):
    return trend.rows_against_range(t, **GAP)


@query("r09_moving_averages", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(revenue as double), 2) as revenue_brl,
           case when count(*) over a = 3 then round(cast(sum(revenue) over a as double) / 3, 2) end as ma_3mo,
           -- sixths of a cent can tie, so this rounds in whole cents
           case when count(*) over b = 6 then ((2 * cast(100 * sum(revenue) over b as hugeint) + 6) // 12) / 100.0::double end as ma_6mo,
           case when count(*) over c = 3 then
               round(100.0 * (cast(revenue as double) - cast(sum(revenue) over c as double) / 3)
                     / nullif(cast(sum(revenue) over c as double) / 3, 0), 1) end as pct_vs_prior_3mo
    from series
    window a as (order by month rows between 2 preceding and current row),
           b as (order by month rows between 5 preceding and current row),
           c as (order by month rows between 3 preceding and 1 preceding)""")
def r09(t):
    return trend.moving_averages(t, **WINDOW)


@query("r10_year_over_year", SERIES + """
    select strftime(s.month, '%Y-%m') as month, round(cast(s.revenue as double), 2) as revenue_brl,
           round(cast(p.revenue as double), 2) as same_month_last_year_brl,
           round(100.0 * cast(s.revenue - p.revenue as double) / nullif(cast(p.revenue as double), 0), 1) as yoy_growth_pct,
           round(cast(n.revenue as double), 2) as next_month_brl
    from series s
    left join series p on p.month = cast(s.month - interval 12 month as date)
    left join series n on n.month = cast(s.month + interval 1 month as date)
    where s.month >= date '1996-01-01'""")
def r10(t):
    return trend.year_over_year(t, shown_from="1996-01-01", **WINDOW)


@query("r11_category_momentum", """
    with q as (
        select l.category,
               sum(case when year(s.bought_at) = 1995 then s.price end) as old,
               sum(case when year(s.bought_at) = 1996 then s.price end) as new
        from v_sold s join v_labelled l using (product_id)
        where l.category is not null and quarter(s.bought_at) = 2 and year(s.bought_at) in (1995, 1996)
        group by 1),
    r as (
        select category, old, new, new - old as change, rank() over (order by new - old desc) as up,
               rank() over (order by new - old) as down
        from q where old >= 20000 and new >= 20000)
    select case when change > 0 then 'growing' else 'shrinking' end as direction, category,
           round(cast(old as double), 2) as q2_2017_brl, round(cast(new as double), 2) as q2_2018_brl,
           round(cast(change as double), 2) as change_brl,
           round(100.0 * cast(change as double) / cast(old as double), 1) as yoy_pct, up as growth_rank
    from r where up <= 10 or down <= 5""")
def r11(t):
    return trend.category_momentum(t, "1995-04-01", "1996-04-01")


@query("r12_frames_on_ties", """
    with who as (
        select c.customer_unique_id as person, count(*) as n
        from v_orders o join v_customers c using (customer_id) where o.order_status = 'delivered'
        group by 1 order by n desc, person limit 1),
    o as (
        select order_id, cast(date_trunc('year', bought_at) as date) as order_date, revenue
        from v_order_value where person in (select person from who))
    select left(cast(order_id as varchar), 8) as order_ref, order_date, round(cast(revenue as double), 2) as order_brl,
           round(cast(sum(revenue) over (order by order_date) as double), 2) as default_frame_range,
           round(cast(sum(revenue) over (order by order_date, order_id rows unbounded preceding) as double), 2) as explicit_rows,
           round(cast(sum(revenue) over (order by order_date, order_id) as double), 2) as unique_order_by
    from o""")
def r12(t):
    return running.frames_on_ties(t, unit="YEAR")


@query("r13_repeat_customer_spend", """
    with who as (
        select person, count(*) as n from v_order_value group by person having count(*) >= 5
        order by n desc, person limit 3)
    select left(cast(person as varchar), 8) as customer, row_number() over w as order_seq,
           cast(bought_at as date) as order_date, round(cast(revenue as double), 2) as order_brl,
           round(cast(sum(revenue) over (w rows unbounded preceding) as double), 2) as cumulative_brl,
           cast(cast(bought_at as date) - lag(cast(bought_at as date)) over w as bigint) as days_since_prev,
           round(100.0 * cast(revenue as double) / cast(sum(revenue) over (partition by person) as double), 1) as pct_of_lifetime
    from v_order_value where person in (select person from who)
    window w as (partition by person order by bought_at, order_id)""")
def r13(t):
    return running.repeat_customer_spend(t)


STATE_MONTHS = """
    with sm as (
        select state, cast(date_trunc('month', bought_at) as date) as month, sum(revenue) as revenue
        from v_order_value
        where bought_at >= timestamp '2000-01-01' and bought_at < timestamp '2000-09-01' and state in ({states})
        group by all)"""


@query("r14_cumulative_by_state", STATE_MONTHS.format(states=", ".join(f"'{s}'" for s in STATES)) + """
    select state as customer_state, strftime(month, '%Y-%m') as month, round(cast(revenue as double), 2) as month_brl,
           round(cast(sum(revenue) over (partition by state order by month) as double), 2) as cumulative_brl,
           round(100.0 * cast(sum(revenue) over (partition by state order by month) as double)
                 / cast(sum(revenue) over (partition by state) as double), 1) as pct_of_state_total
    from sm""")
def r14(t):
    return running.cumulative_by_state(t, "2000-01-01", "2000-09-01", STATES)


@query("r15_pareto_sellers", """
    with s as (select seller_id, sum(price) as revenue from v_sold group by seller_id),
    c as (
        select seller_id, revenue, row_number() over (order by revenue desc, seller_id) as place,
               round(100.0 * cast(sum(revenue) over (order by revenue desc, seller_id) as double)
                     / cast(sum(revenue) over () as double), 3) as reached, count(*) over () as n
        from s),
    b as (select *, coalesce(lag(reached) over (order by place), 0) as before from c)
    select place as sellers_needed, round(100.0 * place / n, 1) as pct_of_all_sellers,
           round(cast(revenue as double), 2) as this_seller_brl, reached as cumulative_revenue_pct
    from b where exists (select 1 from (values (25), (50), (80), (90), (99)) x(cut) where before < cut and reached >= cut)""")
def r15(t):
    return running.pareto_sellers(t)


@query("r16_first_and_last_values", STATE_MONTHS.format(states=", ".join(f"'{s}'" for s in STATES[:3])) + """
    select state as customer_state, strftime(month, '%Y-%m') as month, round(cast(revenue as double), 2) as month_brl,
           round(cast(max(revenue) over (partition by state) as double), 2) as best_month_brl,
           round(cast(last_value(revenue) over (partition by state order by revenue desc) as double), 2) as worst_month_broken,
           round(cast(min(revenue) over (partition by state) as double), 2) as worst_month_fixed,
           round(cast(min(revenue) over (partition by state) as double), 2) as worst_month_via_min
    from sm""")
def r16(t):
    return running.first_and_last_values(t, "2000-01-01", "2000-09-01", STATES[:3])


@query("r17_lifetime_value_methods", """
    with b as (
        select 'grouped by customer_unique_id (correct)' as method, person as who, count(*) as n, sum(revenue) as v
        from v_order_value group by person
        union all
        select 'grouped by customer_id (wrong)', customer_id, count(*), sum(revenue)
        from v_order_value group by customer_id)
    select method, count(*) as distinct_customers, round(cast(sum(v) as double) / count(*), 2) as avg_ltv_brl,
           round(cast(max(v) as double), 2) as max_ltv_brl, round(cast(sum(n) as double) / count(*), 3) as avg_orders_per_customer,
           round(100.0 * cast(sum(case when n > 1 then 1 else 0 end) as double) / count(*), 2) as pct_repeat_buyers
    from b group by method""")
def r17(t):
    return customers.lifetime_value_methods(t)


@query("r18_value_segments", """
    with p as (select person, count(*) as n, sum(revenue) as v from v_order_value group by person),
    g as (
        select case when n > 1 then case when v >= 1000000 then '1. repeat, high value' else '2. repeat, standard' end
                    when v >= 1000000 then '3. one-off, high value'
                    when v >= 300000 then '4. one-off, standard' else '5. one-off, low value' end as segment, v
        from p)
    select segment, count(*) as customers,
           round(100.0 * count(*) / (select count(*) from g), 2) as pct_of_customers,
           round(cast(sum(v) as double), 2) as segment_revenue_brl,
           round(100.0 * cast(sum(v) as double) / (select cast(sum(v) as double) from g), 2) as pct_of_revenue,
           round(cast(sum(v) as double) / count(*), 2) as avg_ltv_brl
    from g group by segment""")
def r18(t):
    return customers.value_segments(t, high=1_000_000, standard=300_000)


BRANCH = """
    with leaf as (select zip, state, sum(revenue) as revenue, count(*) as orders from v_order_value group by all),
    node as (
        select d.depth, left(zip, d.depth) as node, sum(revenue) as revenue, sum(orders) as orders,
               count(distinct zip) as zips, min(state) as state
        from leaf join (values (1), (2), (3), (4), (5)) d(depth) on true group by all)
    select cast(depth as bigint) as depth, node as zip_prefix, state as example_state, zips as leaf_zips,
           cast(orders as bigint) as orders, round(cast(revenue as double), 2) as revenue_brl,
           round(100.0 * cast(revenue as double) / (select cast(sum(revenue) as double) from leaf), 2) as pct_of_national
    from node where node in ('0', '01', '011') or (depth = 4 and node like '011%')"""


@query("r19_zip_rollup", BRANCH)
def r19(t):
    return customers.zip_rollup(t)


@query("r19_zip_rollup_from_tree", BRANCH)
def r19_tree(t):
    return customers.zip_rollup_from_tree(t)


@query("r20_rollup_balance", """
    with leaf as (select distinct zip from v_order_value)
    select cast(d.depth as bigint) as depth, (select count(distinct left(zip, d.depth)) from leaf) as nodes_at_this_depth,
           (select round(cast(sum(revenue) as double), 2) from v_order_value) as total_revenue_brl
    from (values (1), (2), (3), (4), (5)) d(depth)""")
def r20(t):
    return customers.rollup_balance(t)


# Dated deliveries with day-level lateness.
DATED = """
    with dated as (
        select order_id, customer_id, cast(order_delivered_customer_date as date) as arrived,
               cast(order_estimated_delivery_date as date) as promised, cast(order_purchase_timestamp as date) as bought
        from v_orders
        where order_status = 'delivered' and order_delivered_customer_date is not null
          and order_estimated_delivery_date is not null)"""


@query("r21_late_rate_by_state", DATED + """,
    g as (
        select v.seller_state, d.order_id, any_value(d.arrived) as arrived, any_value(d.promised) as promised,
               any_value(d.bought) as bought
        from dated d join v_items i using (order_id) join v_sellers v using (seller_id) group by 1, 2)
    select seller_state, count(*) as orders, count(*) filter (arrived > promised) as late_orders,
           round(100.0 * count(*) filter (arrived > promised) / count(*), 2) as pct_late,
           round(cast(sum(arrived - bought) as double) / count(*), 1) as avg_days_to_deliver,
           round(avg(case when arrived > promised then arrived - promised end), 1) as avg_days_late
    from g group by seller_state having count(*) >= 300""")
def r21(t):
    return delivery.late_rate_by_state(t)


@query("r22_fan_out_trap", """
    with naive as (
        select count(*) as n, sum(i.price) as a, sum(p.payment_value) as b
        from v_orders o join v_items i using (order_id) join v_payments p using (order_id)
        where o.order_status = 'delivered'),
    apart as (
        select count(*) as n, sum(i.a) as a, sum(p.b) as b
        from v_orders o
        join (select order_id, sum(price) as a from v_items group by 1) i using (order_id)
        left join (select order_id, sum(payment_value) as b from v_payments group by 1) p using (order_id)
        where o.order_status = 'delivered')
    select 'WRONG: both children joined directly' as method, n as row_count,
           round(cast(a as double), 2) as item_revenue_brl, round(cast(b as double), 2) as payment_total_brl from naive
    union all
    select 'CORRECT: each child pre-aggregated', n, round(cast(a as double), 2), round(cast(b as double), 2) from apart""")
def r22(t):
    return delivery.fan_out_trap(t)


@query("r23_lateness_by_distance", DATED + """,
    legs as (
        select d.order_id, d.arrived, d.promised, d.bought,
               2 * 6371 * asin(sqrt(power(sin(radians(b.lat - a.lat) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lng - a.lng) / 2), 2))) as km
        from dated d join v_customers c using (customer_id) join v_items i using (order_id)
        join v_sellers s using (seller_id)
        left join v_centroid a on a.zip = s.seller_zip_code_prefix
        left join v_centroid b on b.zip = c.customer_zip_code_prefix),
    far as (
        select order_id, max(km) as km, any_value(arrived) as arrived, any_value(promised) as promised,
               any_value(bought) as bought
        from legs group by order_id)
    select case when km is null then 'z. zip not in geolocation' when km >= 1000 then 'e. over 1000 km'
                when km >= 500 then 'd. 500-1000 km' when km >= 200 then 'c. 200-500 km'
                when km >= 50 then 'b. 50-200 km' else 'a. under 50 km' end as distance_band,
           count(*) as orders, round(100.0 * count(*) / (select count(*) from far), 2) as pct_of_orders,
           round(cast(sum(arrived - bought) as double) / count(*), 1) as avg_days_to_deliver,
           round(100.0 * count(*) filter (arrived > promised) / count(*), 2) as pct_late
    from far group by 1""")
def r23(t):
    return delivery.lateness_by_distance(t)


@query("r24_reviews_by_outcome", DATED + """,
    scored as (
        select d.order_id, d.arrived - d.promised as gap,
               (select cast(sum(r.review_score) as double) / count(*) from v_reviews r where r.order_id = d.order_id) as score
        from dated d)
    select case when gap > 10 then 'f. more than 10 days late' when gap > 3 then 'e. 4-10 days late'
                when gap > 0 then 'd. 1-3 days late' when gap = 0 then 'c. on the promised day'
                when gap > -10 then 'b. 1-9 days early' else 'a. 10+ days early' end as delivery_outcome,
           count(*) as orders, count(score) as orders_reviewed, count(*) filter (score is null) as orders_not_reviewed,
           round(avg(score), 2) as avg_review_score,
           round(100.0 * count(*) filter (score <= 2) / nullif(cast(count(score) as double), 0), 1) as pct_scoring_1_or_2
    from scored group by 1""")
def r24(t):
    return delivery.reviews_by_outcome(t)


@query("r25_worst_sellers", DATED + """,
    score as (select order_id, avg(review_score) as score from v_reviews group by 1),
    pairs as (select distinct i.seller_id, d.order_id, d.arrived > d.promised as late from dated d join v_items i using (order_id)),
    seller as (
        select p.seller_id, count(*) as n, count(*) filter (late) as bad, avg(score) as score
        from pairs p left join score using (order_id) group by 1 having count(*) >= 100)
    select left(cast(x.seller_id as varchar), 8) as seller, v.seller_state, n as orders, bad as late_orders,
           round(100.0 * bad / n, 1) as pct_late, round(score, 2) as avg_review_score,
           (select round(cast(sum(price) as double), 2) from v_sold s where s.seller_id = x.seller_id) as seller_revenue_brl
    from seller x join v_sellers v on v.seller_id = x.seller_id
    order by pct_late desc, x.seller_id limit 15""")
def r25(t):
    return delivery.worst_sellers(t)


@query("r26_late_by_comparison", """
    select count(*) as orders, count(*) filter (arrived_at > promised_at) as late_by_timestamp,
           round(100.0 * count(*) filter (arrived_at > promised_at) / count(*), 2) as pct_by_timestamp,
           count(*) filter (cast(arrived_at as date) > cast(promised_at as date)) as late_by_date,
           round(100.0 * count(*) filter (cast(arrived_at as date) > cast(promised_at as date)) / count(*), 2) as pct_by_date,
           count(*) filter (arrived_at > promised_at and cast(arrived_at as date) = cast(promised_at as date)) as same_day_arrivals
    from (select order_delivered_customer_date as arrived_at, order_estimated_delivery_date as promised_at
          from v_orders where order_status = 'delivered')
    where arrived_at is not null and promised_at is not null""")
def r26(t):
    return delivery.late_by_comparison(t)


@query("r27_geolocation_fan_out", """
    with x as (
        select c.customer_zip_code_prefix as zip, s.price from v_sold s join v_customers c using (customer_id)),
    plain as (select count(*) as n, sum(price) as v from x),
    mid as (select count(*) as n from x join v_centroid using (zip)),
    raw as (select count(*) as n, sum(x.price) as v from x join v_geo using (zip))
    select plain.n as item_rows, mid.n as rows_with_centroid, raw.n as rows_with_raw_points,
           round(cast(plain.v as double), 2) as revenue_brl, round(cast(raw.v as double), 2) as revenue_with_raw_points_brl,
           round(100.0 * raw.n / mid.n, 1) as raw_points_pct
    from plain, mid, raw""")
def r27(t):
    return delivery.geolocation_fan_out(t)


@query("r28_repeat_revenue_share", """
    with p as (select person, count(*) > 1 as is_repeat, sum(revenue) as v from v_order_value group by person)
    select is_repeat, count(*) as people, round(cast(sum(v) as double), 2) as revenue_brl,
           round(100.0 * count(*) / (select count(*) from p), 2) as pct_of_people,
           round(100.0 * cast(sum(v) as double) / (select cast(sum(v) as double) from p), 2) as pct_of_revenue
    from p group by is_repeat""")
def r28(t):
    return customers.repeat_revenue_share(t)


@query("r29_order_history", """
    select c.customer_unique_id, o.order_id, o.order_status, cast(o.order_purchase_timestamp as date) as order_date
    from v_orders o join v_customers c using (customer_id) where c.customer_unique_id = 42""")
def r29(t):
    return delivery.order_history(t, 42)


@query("r30_unmapped_orders", DATED + """,
    legs as (
        select d.order_id, c.customer_zip_code_prefix as cz, s.seller_zip_code_prefix as sz
        from dated d join v_customers c using (customer_id) join v_items i using (order_id) join v_sellers s using (seller_id))
    select 'customer' as side, count(distinct order_id) as orders from legs where cz not in (select zip from v_centroid)
    union all
    select 'seller', count(distinct order_id) from legs where sz not in (select zip from v_centroid)""")
def r30(t):
    return delivery.unmapped_orders(t)
