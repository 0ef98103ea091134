"""Lists, prices, weights, limits and texts that results depend on."""

from decimal import Decimal

# Calendar labels, Monday first.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Day parts. Bounds in seconds of the day; Evening includes 20:00:00 itself.
DAY_PARTS = ["Morning", "Afternoon", "Evening", "Outside hours"]
MORNING_START = 8 * 3600
AFTERNOON_START = 11 * 3600
EVENING_START = 16 * 3600
EVENING_LAST = 20 * 3600

# Three-hour weekday segments, half-open, the last one open-ended.
SEGMENT_START = [11 * 3600, 14 * 3600, 17 * 3600]
SEGMENT_HOURS = 3
REVENUE_SEGMENTS = ["1. Lunch_Rush (11–14)", "2. Dead_Hours (14–17)", "3. Evening_Peak (17–20)"]
WEEKDAY_SEGMENTS = ["1. Lunch (11-14)", "2. Dead (14-17)", "3. Evening (17-20)"]

# List prices by drink.
DRINK_PRICES = [
    ("Cappuccino", 320),
    ("Flat white", 340),
    ("Latte", 340),
    ("Latte with add", 440),
    ("Warming drinks (tea)", 400),
    ("Espresso", 230),
    ("Batch brew", 240),
    ("Raf coffee", 420),
]

# Drinks sold out of 3547, used as weights.
DRINK_WEIGHTS = [
    ("Cappuccino", 889),
    ("Latte", 677),
    ("Latte (with add: caramel, peanut paste, halva)", 486),
    ("Batch brew", 564),
    ("Flat white", 287),
    ("Raf coffee", 276),
    ("Warming drinks (tea)", 239),
    ("Espresso", 129),
]

# Share of a day's orders by day part.
WEEKDAY_SHARES = [("morning", Decimal("0.40")), ("afternoon", Decimal("0.50")), ("evening", Decimal("0.10"))]
WEEKEND_SHARES = [("morning", Decimal("0.20")), ("afternoon", Decimal("0.60")), ("evening", Decimal("0.20"))]

# Normal quantiles by service level, and service level by product class.
Z_BY_SERVICE_LEVEL = {0.80: 0.84, 0.90: 1.28, 0.95: 1.65, 0.99: 2.33}
SERVICE_LEVELS = {
    "Хиты продаж": 0.99,
    "Основной ассортимент": 0.95,
    "Сезонные товары": 0.90,
    "Уценённые/остатки": 0.80,
}

# Report texts.
STOCK_OK = "OK"
STOCK_SHORTAGE = "Недостача"
STOCK_SURPLUS = "Излишек"
SKEW_WARNING = "Внимание: возможны выбросы"
SKEW_NORMAL = "Распределение нормальное"

# Order statuses.
RETURNED = "returned"
RETURN_STATUSES = ["returned", "delivered", "in_transit"]

# Default calendar bounds.
CALENDAR_START = "1770-01-01"
CALENDAR_END = "2030-12-31"

# Column comments of the date dimension.
CALENDAR_COMMENTS = {
    "date_key": "Unique key in YYYYMMDD format",
    "date": "Actual date",
    "is_weekend": "TRUE if the day is Saturday or Sunday",
    "fiscal_year": "Fiscal year starting from July",
}
