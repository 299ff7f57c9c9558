"""The extended mini shop of the reference course (lesson seed
plus the assignment's extra customers, orders, lines and payments), as given."""

CUSTOMERS = ("customer_id int, customer_code string, province string", [
    (1, "CUS-0000001", "กรุงเทพมหานคร"), (2, "CUS-0000002", "เชียงใหม่"), (3, "CUS-0000003", "ขอนแก่น"),
    (4, "CUS-0000004", "ภูเก็ต"), (5, "CUS-0000005", "ชลบุรี"), (6, "CUS-0000006", "กรุงเทพมหานคร"),
    (7, "CUS-0000007", "เชียงใหม่"), (8, "CUS-0000008", "กรุงเทพมหานคร"),
])

PRODUCTS = ("product_id int, sku string, category string, price int", [
    (1, "ACC-ANK-00001", "Electronics", 290), (2, "AUD-SNY-00001", "Electronics", 3990),
    (3, "SKN-MIS-00001", "Beauty", 259), (4, "SNK-TAS-00001", "Food", 35),
    (5, "MEN-UNQ-00001", "Fashion", 390), (6, "BKS-NMB-00001", "Books", 159),
])

ORDERS = ("order_id int, order_number string, customer_id int, ordered_at string, status string", [
    (101, "ORD-260301-000001", 1, "2026-03-01 10:15", "completed"),
    (102, "ORD-260301-000002", 2, "2026-03-01 20:40", "completed"),
    (103, "ORD-260302-000001", 1, "2026-03-02 09:05", "cancelled"),
    (104, "ORD-260305-000001", 3, "2026-03-05 21:30", "completed"),
    (105, "ORD-260305-000002", 4, "2026-03-05 22:10", "shipped"),
    (106, "ORD-260310-000001", 1, "2026-03-10 12:00", "completed"),
    (107, "ORD-260310-000002", 5, "2026-03-10 19:45", "pending_payment"),
    (108, "ORD-260320-000001", 7, "2026-03-20 15:10", "completed"),
    (109, "ORD-260322-000001", 2, "2026-03-22 21:05", "completed"),
    (110, "ORD-260326-000001", 8, "2026-03-26 08:40", "cancelled"),
])

ORDER_ITEMS = ("order_id int, line_number int, product_id int, quantity int, unit_price int", [
    (101, 1, 1, 2, 290), (101, 2, 4, 3, 35), (102, 1, 3, 1, 259), (103, 1, 2, 1, 3990),
    (104, 1, 5, 2, 390), (104, 2, 4, 5, 35), (104, 3, 3, 1, 259), (105, 1, 2, 1, 3990),
    (106, 1, 1, 1, 290), (107, 1, 5, 1, 390),
    (108, 1, 3, 2, 259), (108, 2, 5, 1, 390), (109, 1, 2, 1, 3790), (109, 2, 1, 2, 290), (110, 1, 4, 10, 35),
])

PAYMENTS = ("payment_id int, order_id int, attempt int, method string, amount int, status string", [
    (1, 101, 1, "card", 685, "success"), (2, 102, 1, "promptpay", 259, "success"),
    (3, 103, 1, "card", 3990, "failed"), (4, 104, 1, "card", 1214, "failed"),
    (5, 104, 2, "promptpay", 1214, "success"), (6, 105, 1, "cod", 3990, "pending"),
    (7, 106, 1, "promptpay", 290, "success"),
    (8, 108, 1, "card", 908, "success"), (9, 109, 1, "card", 4370, "failed"),
    (10, 109, 2, "card", 4370, "failed"), (11, 109, 3, "promptpay", 4370, "success"),
    (12, 110, 1, "promptpay", 350, "failed"),
])
