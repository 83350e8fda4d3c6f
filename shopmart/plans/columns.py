"""Output columns of every registered query (generated from the Spark schemas;
tests/test_oracle.py keeps it in sync)."""

COLUMNS = {
    'fill_defaults': ['order_id', 'user_id', 'user_phone', 'store_id', 'store_address', 'address_text', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost', 'driver_id', 'driver_phone', 'item_id', 'item_title', 'item_category', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'users': ['user_id', 'user_phone'],
    'stores': ['store_id', 'store_address', 'store_city'],
    'drivers': ['driver_id', 'driver_phone'],
    'items': ['item_id', 'item_title', 'item_category'],
    'orders': ['order_id', 'user_id', 'store_id', 'address_text', 'delivery_city', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost'],
    'order_items': ['order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'order_drivers': ['order_id', 'driver_id'],
    'order_items_sk': ['order_item_sk', 'order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'order_drivers_sk': ['order_driver_sk', 'order_id', 'driver_id'],
    'orders_enriched': ['order_id', 'user_id', 'store_id', 'store_address', 'city', 'created_at', 'delivered_at', 'canceled_at', 'order_cancellation_reason', 'order_discount', 'delivery_cost', 'report_date', 'report_year', 'report_month', 'report_day'],
    'order_lines': ['order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'order_discount', 'report_date', 'city', 'store_id', 'gross_line_amount', 'net_quantity', 'revenue_line_amount'],
    'order_financials': ['order_id', 'gross_amount_items', 'revenue_amount_items'],
    'driver_stats': ['order_id', 'driver_count', 'has_driver_change'],
    'active_drivers': ['report_date', 'city', 'store_id', 'active_drivers_cnt'],
    'orders_fact': ['order_id', 'user_id', 'store_id', 'store_address', 'city', 'created_at', 'delivered_at', 'canceled_at', 'order_cancellation_reason', 'order_discount', 'delivery_cost', 'report_date', 'report_year', 'report_month', 'report_day', 'gross_amount_order', 'revenue_amount_order', 'profit_amount_order', 'has_driver_change', 'is_delivered', 'is_canceled', 'is_canceled_after_delivery', 'is_canceled_service_fault'],
    'dm_orders': ['report_date', 'report_year', 'report_month', 'report_day', 'city', 'store_id', 'store_address', 'gross_amount', 'revenue_amount', 'profit_amount', 'orders_created_cnt', 'orders_delivered_cnt', 'orders_canceled_cnt', 'orders_canceled_after_delivery_cnt', 'orders_canceled_service_fault_cnt', 'buyers_cnt', 'avg_check_amount', 'orders_per_buyer', 'revenue_per_buyer', 'orders_with_driver_change_cnt', 'active_drivers_cnt'],
    'item_fact': ['order_id', 'item_id', 'item_title', 'item_category', 'store_id', 'store_address', 'city', 'report_date', 'report_year', 'report_month', 'report_day', 'report_week', 'item_quantity', 'item_canceled_quantity', 'item_gross_amount_calc', 'has_item_cancellation'],
    'dm_items_base': ['report_date', 'report_year', 'report_month', 'report_day', 'report_week', 'city', 'store_id', 'store_address', 'item_category', 'item_id', 'item_title', 'item_gross_amount', 'ordered_quantity', 'canceled_quantity', 'orders_with_item_cnt', 'orders_with_item_cancellation_cnt'],
    'dm_items': ['report_date', 'report_year', 'report_month', 'report_day', 'report_week', 'city', 'store_id', 'store_address', 'item_category', 'item_id', 'item_title', 'item_gross_amount', 'ordered_quantity', 'canceled_quantity', 'orders_with_item_cnt', 'orders_with_item_cancellation_cnt', 'daily_popularity_rank', 'daily_reverse_popularity_rank', 'weekly_popularity_rank', 'weekly_reverse_popularity_rank', 'monthly_popularity_rank', 'monthly_reverse_popularity_rank'],
    'q1_weekday_totals': ['day_of_week_num', 'day_of_week', 'total_gross', 'total_revenue', 'total_profit'],
    'q2_monthly_buyers': ['report_year', 'report_month', 'avg_check', 'avg_orders_per_buyer', 'avg_revenue_per_buyer'],
    'q3_best_check_stores': ['city', 'store_id', 'store_address', 'avg_check'],
    'q4_driver_change_rate': ['city', 'store_id', 'store_address', 'total_orders', 'driver_changed_orders', 'driver_change_rate_pct'],
    'q5_category_turnover': ['item_category', 'total_gross'],
    'q6_most_canceled_items': ['item_id', 'item_title', 'item_category', 'total_canceled_quantity'],
    'q7_item_cancel_rate': ['item_id', 'item_title', 'item_category', 'total_ordered', 'total_canceled', 'cancel_rate_pct'],
    'q8_item_order_cancel_rate': ['item_id', 'item_title', 'item_category', 'total_orders_with_item', 'canceled_orders_with_item', 'cancellation_rate_pct'],
    'check_not_null_core': ['table_name', 'column_name', 'null_rows'],
    'check_not_null_marts': ['table_name', 'column_name', 'null_rows'],
    'check_unique_users': ['user_id', 'n_rows'],
    'check_unique_stores': ['store_id', 'n_rows'],
    'check_unique_drivers': ['driver_id', 'n_rows'],
    'check_unique_items': ['item_id', 'n_rows'],
    'check_unique_orders': ['order_id', 'n_rows'],
    'check_unique_order_items_sk': ['order_item_sk', 'n_rows'],
    'check_unique_order_drivers_sk': ['order_driver_sk', 'n_rows'],
    'check_unique_order_drivers_pair': ['order_id', 'driver_id', 'n_rows'],
    'check_unique_raw_order_item': ['order_id', 'item_id', 'n_rows'],
    'check_unique_raw_user': ['user_id', 'n_rows'],
    'check_unique_raw_store': ['store_id', 'n_rows'],
    'check_unique_raw_driver': ['driver_id', 'n_rows'],
    'check_unique_raw_item': ['item_id', 'n_rows'],
    'check_unique_raw_order': ['order_id', 'n_rows'],
    'check_unique_raw_order_driver': ['order_id', 'driver_id', 'n_rows'],
    'check_unique_order_items_line': ['order_id', 'item_id', 'n_rows'],
    'check_unique_dm_orders_day_city': ['report_date', 'city', 'n_rows'],
    'check_unique_dm_items_day_item': ['report_date', 'item_id', 'n_rows'],
    'check_fk_orders_store_with_city': ['order_id', 'user_id', 'store_id', 'address_text', 'delivery_city', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost'],
    'check_fk_order_drivers_delivered': ['order_id', 'driver_id'],
    'check_unique_dm_orders': ['report_date', 'city', 'store_id', 'n_rows'],
    'check_unique_dm_items': ['report_date', 'city', 'store_id', 'item_id', 'n_rows'],
    'check_fk_orders_user': ['order_id', 'user_id', 'store_id', 'address_text', 'delivery_city', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost'],
    'check_fk_orders_store': ['order_id', 'user_id', 'store_id', 'address_text', 'delivery_city', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost'],
    'check_fk_order_items_order': ['order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'check_fk_order_items_item': ['order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'check_fk_order_items_replaced_item': ['order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'check_fk_order_drivers_order': ['order_id', 'driver_id'],
    'check_fk_order_drivers_driver': ['order_id', 'driver_id'],
    'check_rules_order_items': ['check_name', 'order_id', 'item_id', 'item_quantity', 'item_price', 'item_canceled_quantity', 'item_discount', 'item_replaced_id'],
    'check_rules_orders': ['check_name', 'order_id', 'user_id', 'store_id', 'address_text', 'delivery_city', 'created_at', 'paid_at', 'delivery_started_at', 'delivered_at', 'canceled_at', 'payment_type', 'order_discount', 'order_cancellation_reason', 'delivery_cost'],
}
