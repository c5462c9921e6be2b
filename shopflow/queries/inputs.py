"""The derived shop tables themselves; every other query builds on them."""

from shopflow.queries.registry import query

for _name in [
    "behavior_events", "raw_events", "impressions", "recommendation_requests", "sessions", "users", "user_preferences",
    "products", "order_items", "predictions",
]:
    query(f"input_{_name}", f"select * from {_name}")(lambda shop, name=_name: getattr(shop, name))

query("input_product_snapshots", "select * from product_snapshots")(lambda shop: shop.product_snapshots.drop("created_ts"))
query("input_orders", "select * from shop_orders")(lambda shop: shop.orders)
