"""Fixed values of the commodity domain."""

from __future__ import annotations

# --- Fixed values: keys, word lists, constants and texts that results must reproduce exactly. ---

COMMODITY_IDS = {
    "rice": 1,
    "coffee": 2,
    "pepper": 3,
    "cashew": 4,
    "rubber": 5,
    "cocoa": 6,
    "cotton": 7,
}

# raw name, commodity, Vietnamese name (ASCII), category
COMMODITY_MAPPING = [
    ("rice", "rice", "Lua gao", "grains"),
    ("gao", "rice", "Lua gao", "grains"),
    ("lua", "rice", "Lua gao", "grains"),
    ("paddy", "rice", "Lua gao", "grains"),
    ("coffee", "coffee", "Ca phe", "beverages"),
    ("ca phe", "coffee", "Ca phe", "beverages"),
    ("pepper", "pepper", "Ho tieu", "spices"),
    ("black pepper", "pepper", "Ho tieu", "spices"),
    ("ho tieu", "pepper", "Ho tieu", "spices"),
    ("cashew", "cashew", "Dieu", "nuts"),
    ("cashew nut", "cashew", "Dieu", "nuts"),
    ("dieu", "cashew", "Dieu", "nuts"),
    ("rubber", "rubber", "Cao su", "industrial_crops"),
    ("natural rubber", "rubber", "Cao su", "industrial_crops"),
    ("cao su", "rubber", "Cao su", "industrial_crops"),
    ("cocoa", "cocoa", "Cocoa", "beverages"),
    ("cacao", "cocoa", "Cocoa", "beverages"),
    ("cotton", "cotton", "Cotton", "fiber_crops"),
    ("coffee, arabica", "coffee", "Ca phe", "beverages"),
    ("rice, thai 5%", "rice", "Lua gao", "grains"),
    ("cotton, a index", "cotton", "Cotton", "fiber_crops"),
]

PRICE_SCOPE = ["rice", "coffee", "cocoa", "cotton"]

MONTHLY_SOURCE = "WORLD_BANK"
DAILY_SOURCE = "YAHOO_FINANCE"
DAILY_MONTHLY_AVG_SOURCE = "YAHOO_FINANCE_MONTHLY_AVG"
MONTHLY_RAW_SOURCE = "world_bank_pink_sheet"
MISSING_PERIOD = "nan"
DAILY_RAW_SOURCE = "yahoo_finance"

MONTHLY_REGION, MONTHLY_COUNTRY = "global", "World"
DAILY_REGION, DAILY_COUNTRY = "US futures market", "United States"

LB_TO_KG = 0.45359237
CWT_TO_KG = 45.359237
MILLED_RICE_FACTOR = 2.2
USD_TO_VND = 25_000

TICKERS = {"KC=F": "coffee", "ZR=F": "rice", "CC=F": "cocoa", "CT=F": "cotton"}
THRESHOLDS = {"coffee": 5.0, "rice": 3.0, "cocoa": 5.0, "cotton": 4.0}
DEFAULT_THRESHOLD = 5.0

# keyword in the monthly sheet's header -> commodity
SHEET_KEYWORDS = {
    "Coffee, Arabica": "coffee",
    "Rice, Thai 5%": "rice",
    "Cocoa": "cocoa",
    "Cotton, A Index": "cotton",
}

HOLIDAYS = ["01-01", "04-30", "05-01", "09-02"]
CALENDAR_START, CALENDAR_END, CALENDAR_LOOKAHEAD_DAYS = "2000-01-01", "2026-12-31", 370

HARVEST_MONTHS = {
    "rice": [6, 7, 8, 9],
    "coffee": [10, 11, 12, 1],
    "pepper": [2, 3, 4, 5],
    "cashew": [2, 3, 4],
    "rubber": [5, 6, 7, 8, 9, 10],
    "cocoa": [10, 11, 12, 1, 2, 3],
    "cotton": [8, 9, 10, 11, 12],
}

DOMESTIC_COUNTRIES = ["vietnam", "viet nam"]

DISPLAY_NAMES = {
    "rice": "Gạo",
    "coffee": "Cà phê",
    "pepper": "Tiêu",
    "cashew": "Hạt điều",
    "rubber": "Cao su",
    "cocoa": "Cocoa",
    "cotton": "Cotton",
}
DISPLAY_MARKS = {
    "rice": "🌾",
    "coffee": "☕",
    "pepper": "🌶️",
    "cashew": "🥜",
    "rubber": "🌿",
    "cocoa": "CO",
    "cotton": "CT",
}
# The market summary knows only these five; other commodities keep their code and get no mark.
SUMMARY_NAMES = {c: DISPLAY_NAMES[c] for c in ["rice", "coffee", "pepper", "cashew", "rubber"]}
SUMMARY_MARKS = {c: DISPLAY_MARKS[c] for c in ["rice", "coffee", "pepper", "cashew", "rubber"]}

SUMMARY_TITLE = "DỮ LIỆU THỊ TRƯỜNG NÔNG SẢN VIỆT NAM — "
SUMMARY_RULE = "=" * 50
SUMMARY_EMPTY = "Không có dữ liệu thị trường."
SUMMARY_VERSUS = "so với tháng trước"
SUMMARY_ALL = "TẤT CẢ MẶT HÀNG (giá hiện tại):"
SUMMARY_YEARS = "LỊCH SỬ GIÁ TRUNG BÌNH THEO NĂM (Quy đổi {currency}/kg):"
SUMMARY_YEAR = "  Năm "
SUMMARY_RANGE = ("Dữ liệu bắt đầu từ: ", " → Cập nhật mới nhất: ")
SUMMARY_FOOTER = [
    "Nguồn: World Bank & Yahoo Finance",
    "5 mặt hàng xuất khẩu chủ lực của Việt Nam: gạo, cà phê, tiêu, hạt điều, cao su",
]
DIRECTION_UP, DIRECTION_DOWN = "tăng", "giảm"
TREND_UP, TREND_DOWN = "Tăng", "Giảm"
REPORT_HEADERS = ["Tháng", "Mặt hàng", "Giá ({currency}/kg)", "% Thay đổi", "TB 7 ngày", "TB 30 ngày"]
CORRELATION_BANDS = {"strong": "mạnh", "medium": "trung bình", "weak": "yếu"}

MODEL_FEATURES = ["price_usd_per_kg", "price_lag_1", "price_lag_7", "price_30d_avg", "price_30d_volatility"]
SEQUENCE_LENGTH = 30
TRAIN_MIN_ROWS_ABOVE = 40
FORECAST_STEPS = 6
FORECAST_STEP_DAYS = 30
BAND_BASE, BAND_STEP = 0.05, 0.01
