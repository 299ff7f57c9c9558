"""The 30-row tea-shop seed of the reference course, transcribed
as given (order_id, ordered_at, branch, channel, menu, size, sweetness, qty,
unit_price, discount, member_id, rating)."""

TEA_SCHEMA = ("order_id int, ordered_at string, branch string, channel string, menu string, size string, "
              "sweetness int, qty int, unit_price int, discount int, member_id int, rating int")

TEA_ROWS = [
    (1, "2026-09-14 10:05", "สามย่าน", "walk_in", "ชานมไข่มุก", "M", 50, 1, 55, 0, 101, 5),
    (2, "2026-09-14 11:40", "สามย่าน", "grab", "ชาไทย", "L", 100, 2, 60, 10, None, 4),
    (3, "2026-09-14 12:15", "บางนา", "walk_in", "ชาเขียวมัทฉะ", "M", 25, 1, 70, 0, 102, None),
    (4, "2026-09-14 15:30", "บางนา", "lineman", "ชานมไข่มุก", "L", 50, 3, 65, 15, None, 3),
    (5, "2026-09-14 19:50", "สามย่าน", "walk_in", "โกโก้", "M", 100, 1, 50, 0, 103, 5),
    (6, "2026-09-15 09:10", "บางนา", "walk_in", "ชาไทย", "M", 50, 2, 50, 0, None, None),
    (7, "2026-09-15 11:55", "สามย่าน", "grab", "ชานมไข่มุก", "M", 25, 2, 55, 0, 101, 4),
    (8, "2026-09-15 13:20", "สามย่าน", "lineman", "ชาเขียวมัทฉะ", "L", 0, 1, 80, 0, None, 2),
    (9, "2026-09-15 16:45", "บางนา", "grab", "บราวน์ชูการ์", "L", 50, 2, 75, 20, 104, 5),
    (10, "2026-09-15 20:10", "บางนา", "walk_in", "ชานมไข่มุก", "M", 50, 1, 55, 0, None, None),
    (11, "2026-09-16 08:30", "สามย่าน", "walk_in", "ชาไทย", "M", 100, 1, 50, 0, 105, 4),
    (12, "2026-09-16 12:05", "สามย่าน", "grab", "บราวน์ชูการ์", "M", 50, 2, 65, 0, None, 5),
    (13, "2026-09-16 12:40", "บางนา", "lineman", "ชานมไข่มุก", "L", 25, 4, 65, 30, None, 4),
    (14, "2026-09-16 17:15", "สามย่าน", "walk_in", "โกโก้", "L", 100, 1, 60, 0, 103, 3),
    (15, "2026-09-16 21:00", "บางนา", "grab", "ชาเขียวมัทฉะ", "M", 25, 1, 70, 0, 102, 5),
    (16, "2026-09-17 10:25", "สามย่าน", "walk_in", "ชานมไข่มุก", "M", 50, 2, 55, 10, 101, None),
    (17, "2026-09-17 12:10", "บางนา", "walk_in", "ชาไทย", "L", 50, 1, 60, 0, None, 4),
    (18, "2026-09-17 14:35", "สามย่าน", "lineman", "บราวน์ชูการ์", "L", 50, 1, 75, 0, None, None),
    (19, "2026-09-17 18:50", "บางนา", "grab", "ชานมไข่มุก", "M", 100, 3, 55, 0, 106, 2),
    (20, "2026-09-18 09:45", "สามย่าน", "walk_in", "ชาเขียวมัทฉะ", "M", 0, 1, 70, 0, 105, 5),
    (21, "2026-09-18 12:20", "บางนา", "lineman", "ชาไทย", "M", 100, 5, 50, 25, None, 3),
    (22, "2026-09-18 13:05", "สามย่าน", "grab", "ชานมไข่มุก", "L", 50, 2, 65, 0, None, 4),
    (23, "2026-09-18 19:30", "บางนา", "walk_in", "โกโก้", "M", 50, 1, 50, 0, 104, None),
    (24, "2026-09-19 11:00", "สามย่าน", "walk_in", "บราวน์ชูการ์", "M", 25, 1, 65, 0, 101, 5),
    (25, "2026-09-19 12:30", "บางนา", "grab", "ชานมไข่มุก", "M", 50, 2, 55, 0, None, 4),
    (26, "2026-09-19 15:55", "สามย่าน", "lineman", "ชาไทย", "L", 100, 2, 60, 0, None, 5),
    (27, "2026-09-20 10:15", "บางนา", "walk_in", "ชาเขียวมัทฉะ", "L", 25, 1, 80, 0, 102, 4),
    (28, "2026-09-20 12:45", "สามย่าน", "grab", "ชานมไข่มุก", "M", 50, 6, 55, 50, None, 5),
    (29, "2026-09-20 16:20", "บางนา", "lineman", "บราวน์ชูการ์", "L", 50, 2, 75, 0, 106, 3),
    (30, "2026-09-20 20:40", "สามย่าน", "walk_in", "โกโก้", "M", 100, 1, 50, 0, None, None),
]
