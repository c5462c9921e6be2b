"""The shop tables as DuckDB views, for the independent SQL answers."""

import re

HASH32 = "('0x'||substr(sha256({0}),1,8))::bigint"


def h(text: str) -> str:
    return f"(('0x'||substr(sha256({text}),1,8))::bigint)"


VIEWS = {
    "behavior_events": f"""
        select event_id::varchar event_id, ts event_timestamp, ts created_ts,
          ts + to_seconds(case when late < 100 then late*60 else late % 30 end) ingestion_ts,
          user_id, user_id||'-'||strftime(ts,'%Y%m%d') session_id,
          case when kind <> 'search' then 'req-'||(event_id//20) end request_id,
          case when kind <> 'search' then 'imp-'||(event_id//4) end impression_id,
          kind event_type, k product_id, k % 12 category_id, k % 25 brand_id,
          value::decimal(18,2) price, (k % 10 + 1)::int price_bucket,
          case when kind <> 'search' then (event_id % 3 + 1)::int end quantity,
          case event_id % 3 when 1 then 'mobile' when 2 then 'desktop' end device_type,
          case when kind <> 'search' then 'home' else 'search' end as source,
          case when event_id % 3 <> 0 then 'c'||(k % 4) end campaign_id,
          case when kind = 'purchase' then 'ord-'||event_id end order_id,
          sha256(event_id||'|'||kind||'|'||k) payload_hash, (event_id % 3 + 1)::int schema_version
        from (select event_id, ts, user_id, value, json_extract_string(props,'$.k')::bigint k,
                case event_type when 'view' then 'view' when 'click' then 'click' when 'error' then 'cart'
                  when 'purchase' then 'purchase' when 'signup' then 'search' end kind,
                {h("'late:'||event_id")} % 1000 late from events)""",
    "raw_events": f"""
        select * from behavior_events union all
        select * replace (ingestion_ts + to_seconds(300) as ingestion_ts,
          case when {h("'dup:'||event_id")} % 100 < 5 then sha256('changed:'||payload_hash) else payload_hash end as payload_hash)
        from behavior_events where {h("'dup:'||event_id")} % 100 < 20""",
    "impressions": f"""
        select 'imp-'||g impression_id, 'req-'||(n//20) request_id, user_id, session_id,
          event_timestamp impression_timestamp, product_id candidate_product_id, (g % 5 + 1)::int rank_position,
          case g % 3 when 0 then 'trending' when 1 then 'popular' end candidate_source,
          {h("'retrieval:'||g")} / 4294967296.0::double retrieval_score,
          {h("'ranking:'||g")} / 4294967296.0::double ranking_score, 'home' surface,
          {h("'click:'||g")} % 100 < 10 is_clicked
        from (select event_id::bigint n, event_id::bigint // 4 g, *,
                row_number() over (partition by event_id::bigint // 4 order by event_id::bigint) r from behavior_events)
        where r = 1""",
    "recommendation_requests": f"""
        select request_id, user_id, session_id, request_timestamp, 'home' surface,
          case when draw < 5 then '{{broken' when draw < 10 then '{{"experiment_id":"","variant":""}}'
            when draw >= 15 then '{{"experiment_id":"exp-1","variant":"'||arm||'"}}' end request_context
        from (select request_id, arg_min(user_id, impression_timestamp) user_id,
                arg_min(session_id, impression_timestamp) session_id, min(impression_timestamp) request_timestamp,
                {h("'ctx:'||request_id")} % 100 draw,
                case when {h("'exp-1:'||arg_min(user_id, impression_timestamp)")} % 100 < 50 then 'candidate' else 'control' end arm
              from impressions group by request_id)""",
    "sessions": """
        select session_id, user_id, min(event_timestamp) session_start_ts, max(event_timestamp) session_end_ts
        from behavior_events group by all""",
    "users": f"""
        select c_custkey user_id, timestamp '2023-01-01' + to_days((c_custkey % 365)::int) signup_ts,
          'nation-'||c_nationkey country,
          case when {h("'segment:'||c_custkey")} % 100 >= 6 then c_mktsegment end segment,
          (c_custkey % 7 + 1)::int age_bucket, c_acctbal >= 0 is_active from customer""",
    "user_preferences": """
        select user_id, category_id, brand_id, count(*)::double preference_weight from behavior_events group by all""",
    "products": """
        select p_partkey product_id, p_name product_name, p_partkey % 12 category_id, 'cat.'||lower(p_type) category_code,
          p_partkey % 25 brand_id, p_brand brand_name, p_retailprice::decimal(18,2) current_price,
          (p_partkey % 10 + 1)::int price_bucket, p_size <= 45 is_active, timestamp '2023-06-01' created_ts,
          p_size::double popularity_weight from part""",
    "product_snapshots": """
        select product_id, case step when 0 then timestamp '2023-06-01' else timestamp '2024-01-15' end valid_from,
          case step when 0 then timestamp '2024-01-15' end valid_to, category_id, category_code, brand_id, brand_name,
          (current_price + step)::decimal(18,2) current_price, ((price_bucket + step) % 10 + 1)::int price_bucket, is_active
        from products, (values (0), (1)) s(step)""",
    "order_items": """
        select l_orderkey||'-'||l_linenumber||'-'||l_partkey||'-'||l_suppkey||'-'||strftime(l_shipdate,'%Y%m%d') order_item_id,
          case when l_returnflag = 'A' and l_discount = 0.1 then 'x' else 'o' end||l_orderkey order_id,
          l_partkey product_id, l_quantity::int quantity, l_extendedprice::decimal(18,2) gross,
          (l_extendedprice::decimal(18,2)*l_discount::decimal(4,2))::decimal(18,2) discount_amount,
          (l_extendedprice::decimal(18,2) - (l_extendedprice::decimal(18,2)*l_discount::decimal(4,2))::decimal(18,2))::decimal(18,2) line_amount
        from lineitem""",
    "shop_orders": f"""
        select 'o'||o_orderkey order_id, o_custkey user_id, 's'||o_custkey session_id,
          case o_orderstatus when 'O' then 'Paid' when 'P' then 'Pending' else 'Cancelled' end status,
          gross_amount, discount_amount, net_amount + case when {h("'net:'||o_orderkey")} % 100 < 3 then 1 else 0 end net_amount,
          timestamp '2024-01-01' + to_days((date_diff('day', date '1992-01-01', o_orderdate::date) % 30)::int) order_timestamp
        from orders left join (select order_id, sum(gross) gross_amount, sum(discount_amount) discount_amount,
          sum(line_amount) net_amount from order_items group by 1) i on i.order_id = 'o'||o_orderkey""",
    "cdc_events": f"""
        select event_id, event_timestamp, user_id, product_id, event_type,
          case event_type when 'view' then 1 when 'cart' then 2 when 'purchase' then 3 else 0 end event_type_id,
          case when draw between 10 and 14 then 0 else category_id end category_id, brand_id,
          case when draw between 15 and 19 then price_bucket::double else price::double end price, price_bucket,
          coalesce(request_id,'') request_id, coalesce(impression_id,'') impression_id, payload_hash, ingestion_ts record_timestamp
        from (select *, {h("'cdc:'||event_id")} % 100 draw from behavior_events) where draw >= 10 or draw = 4""",
    "stream_records": f"""
        select event_id, event_timestamp, user_id, product_id, event_type,
          case event_type when 'view' then 1 when 'cart' then 2 when 'purchase' then 3 else 0 end event_type_id,
          case when draw between 10 and 14 then 0 else category_id end category_id, brand_id,
          case when draw between 15 and 19 then price_bucket::double else price::double end price, price_bucket,
          coalesce(request_id,'') request_id, coalesce(impression_id,'') impression_id, payload_hash, ingestion_ts record_timestamp
        from (select *, {h("'cdc:'||event_id")} % 100 draw from raw_events) where draw >= 10 or draw = 4""",
    "watermarks": """
        select *, max((epoch_us(event_timestamp)//1000)) over (order by record_timestamp, payload_hash, event_id rows unbounded preceding) - 3600000 wm,
          row_number() over (partition by event_id order by record_timestamp, payload_hash) > 1 is_duplicate, (epoch_us(event_timestamp)//1000) ms from stream_records""",
    "flagged": """
        select * exclude (wm, ms), greatest(wm - ms, 0) / 1000.0::double late_by_seconds, ms <= wm is_late, wm >= (ms // 60000 + 1) * 60000 + 300000 is_too_late
        from watermarks""",
    "kept": "select * from flagged where not is_duplicate and not is_too_late",
    "predictions": f"""
        select *, round({h("'score:'||prediction_id")} / 4294967296.0::double, 3) score from (
        select l_orderkey||':'||l_linenumber||':'||l_partkey||':'||l_suppkey||':'||strftime(l_shipdate,'%Y%m%d') prediction_id,
          l_orderkey group_id, l_partkey item_id, (l_returnflag = 'R')::int as label,
          l_extendedprice / 100000.0 latency_seconds, (l_tax = 0.08)::int is_error, l_discount confidence,
          l_suppkey user_id, l_shipdate prediction_ts from lineitem)""",
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the statement with the views it mentions, in dependency order."""
    known = {**VIEWS, **(extra or {})}
    names = list(known)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit_body = known[name]
                visit_name = name
                if visit_name in visiting:
                    continue
                visiting.add(visit_name)
                visit(visit_body)
                needed.append(visit_name)

    visiting: set[str] = set()
    visit(sql)
    if not needed:
        return sql.strip()
    body = ",\n".join(f"{name} as ({known[name].strip()})" for name in needed)
    return f"with {body}\n{sql.strip()}"
