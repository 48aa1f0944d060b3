"""Declared schemas of the headered CSV inputs, for ``load_tables(..., csv_schemas=...)``."""

# Column names and types of the commerce and payments inputs.
COMMERCE = {
    "customers": "customer_id INT, name STRING, email STRING, city STRING, country STRING, tier STRING, signup_date DATE",
    "products": "product_id INT, name STRING, category STRING, brand STRING, price DOUBLE",
    "orders": "order_id INT, customer_id INT, order_date DATE, status STRING, total_amount DOUBLE",
    "order_items": "item_id INT, order_id INT, product_id INT, quantity INT, unit_price DOUBLE",
}
PAYMENTS = {
    "users": "user_id INT, name STRING, email STRING, country STRING, tier STRING, kyc_verified BOOLEAN, created_date DATE",
    "merchants": "merchant_id INT, name STRING, mcc_category STRING, city STRING, country STRING",
    "accounts": "account_id INT, user_id INT, account_type STRING, opened_date DATE, balance DOUBLE, status STRING",
    "transactions": "txn_id INT, account_id INT, merchant_id INT, amount DOUBLE, txn_type STRING, txn_date DATE, status STRING",
}
