"""Every literal that results depend on.

Word lists, lookup tables, text patterns, formats and constants that must be
exactly these for results to be right. No logic lives here.
"""

from __future__ import annotations

# --- Fixed values: run window ------------------------------------------------
LOOKAHEAD_DAYS = 30
CHUNK_DAYS = 5
ALL_SOURCES = ("icruise", "expedia", "cruisedirect", "asiayo", "bwt")

# --- Fixed values: target ports (first rule wins) and port groups ------------
PORT_RULES = (
    ("Keelung", ("keelung", "chilung", "jilong", "基隆")),
    ("Yokohama", ("yokohama", "橫濱", "横浜")),
    ("Tokyo", ("tokyo", "東京")),
)
PORT_GROUPS = {"Tokyo": "tokyo/yokohama", "Yokohama": "tokyo/yokohama"}

# --- Fixed values: ship names as written -> official English name ------------
SHIP_ALIASES = {
    "探索星號": "Star Voyager",
    "雲頂夢號": "Genting Dream",
    "世界夢號": "World Dream",
    "鑽石公主號": "Diamond Princess",
    "藍寶石公主號": "Sapphire Princess",
    "太陽公主號": "Sun Princess",
    "星辰公主號": "Star Princess",
    "皇家公主號": "Royal Princess",
    "珊瑚公主號": "Coral Princess",
    "島嶼公主號": "Island Princess",
    "紅寶石公主號": "Ruby Princess",
    "翡翠公主號": "Emerald Princess",
    "千禧號": "Celebrity Millennium",
    "日蝕號": "Celebrity Eclipse",
    "無限號": "Celebrity Infinity",
    "頂峰號": "Celebrity Summit",
    "星宿號": "Celebrity Constellation",
    "極致號": "Celebrity Edge",
    "莎倫娜號": "Costa Serena",
    "賽琳娜號": "Costa Serena",
    "幸運號": "Costa Fortuna",
    "大西洋號": "Costa Atlantica",
    "榮耀號": "MSC Bellissima",
    "華麗號": "MSC Splendida",
    "珍愛號": "MSC Preziosa",
    "海洋光譜號": "Spectrum of the Seas",
    "海洋聖歌號": "Ovation of the Seas",
    "海洋量子號": "Quantum of the Seas",
    "海洋航行者號": "Voyager of the Seas",
    "海洋贊禮號": "Anthem of the Seas",
    "海洋水手號": "Mariner of the Seas",
    "海洋光輝號": "Radiance of the Seas",
    "海洋璀璨號": "Brilliance of the Seas",
    "喜悅號": "Norwegian Joy",
    "暢意號": "Norwegian Spirit",
    "富士號": "Mitsui Ocean Fuji",
    "飛鳥Ⅲ": "Asuka III",
    "飛鳥三號": "Asuka III",
    "日本丸": "Nippon Maru",
    "太平洋世界號": "Pacific World",
}

# --- Fixed values: cruise lines as written -> English name -------------------
LINE_ALIASES = {
    "麗星郵輪": "Star Cruises",
    "麗星遊輪": "Star Cruises",
    "星夢郵輪": "StarDream Cruises",
    "公主郵輪": "Princess Cruises",
    "公主遊輪": "Princess Cruises",
    "名人郵輪": "Celebrity Cruises",
    "名人遊輪": "Celebrity Cruises",
    "MSC郵輪": "MSC Cruises",
    "MSC遊輪": "MSC Cruises",
    "歌詩達": "Costa Cruises",
    "皇家加勒比": "Royal Caribbean International",
    "挪威郵輪": "Norwegian Cruise Line",
    "諾唯真": "Norwegian Cruise Line",
    "維京遊輪": "Viking",
    "維京郵輪": "Viking",
    "三井海洋郵輪": "Mitsui Ocean Cruises",
}

# --- Fixed values: logo slug -> cruise line ----------------------------------
LINE_BY_SLUG = {
    "celebrity": "Celebrity Cruises",
    "princess": "Princess Cruises",
    "royal": "Royal Caribbean International",
    "royalcaribbean": "Royal Caribbean International",
    "carnival": "Carnival Cruise Line",
    "norwegian": "Norwegian Cruise Line",
    "msc": "MSC Cruises",
    "costa": "Costa Cruises",
    "holland": "Holland America Line",
    "hollandamerica": "Holland America Line",
    "cunard": "Cunard",
    "disney": "Disney Cruise Line",
    "oceania": "Oceania Cruises",
    "regent": "Regent Seven Seas Cruises",
    "seabourn": "Seabourn",
    "silversea": "Silversea",
    "viking": "Viking",
    "windstar": "Windstar Cruises",
    "azamara": "Azamara",
    "explora": "Explora Journeys",
}

# --- Fixed values: text patterns (Java syntax; U = Unicode classes) ----------
# A run of white space, or one that is no plain space; a plain one stays as it is.
WHITESPACE = r"(?U)[\s\x1c-\x1f]{2,}|[\s\x1c-\x1f&&[^ ]]"
FIELD_LABEL = (
    r"(?iU)^\s*(?:Starts|Ends|Ports? of Call|Departs|Departing From|Returns|Duration|Ship)\s*:?\s+"
)
NUMBER = r"(?U)\d[\d,]*(?:\.\d+)?"
NIGHTS = r"(?iU)(\d+)\s*Night"
INTEGER = r"(?U)\d+"
CJK = "[぀-ヿ㐀-䶿一-鿿]"
ASCII_NAME = r"[A-Za-z][A-Za-z'.\-]*(?:\s+[A-Za-z][A-Za-z'.\-]*)+"
TITLE_BRACKET = r"【([^】]+)】(.*)$"
NAME_TAIL = r"[～~｜|、，,].*$"
LINE_ONLY = r"(?iU)(?:郵輪|遊輪|郵轮|Cruises?)\s*$"
NAME_EDGE_CHARS = "．・.-　 "
LEADING_BRACKET = r"(?U)^\s*【[^】]*】\s*"
TRAILING_NOTE = r"(?U)[（(][^）)]*[）)]\s*$"
DAYS_TAIL = r"(?U)[0-9０-９一二三四五六七八九十]+\s*天.*$"
TOUR_WORDS = r"自主遊|自由行|之旅|巡航|巡遊|遊$"
DAY_PREFIX = r"(?U)^\s*(?:第\s*[0-9０-９一二三四五六七八九十]+\s*天|Day\s*\d+)\s*[:：]?\s*"
DAY_TRAILER = r"(?iU)\s*(?:【|抵達|啟航|登船|下船|出發|停靠|Arrival|Departs?).*$"
# In one pass: the prefix only stands first, and what the trailer cuts ends the line.
DAY_ENDS = DAY_PREFIX + "|" + DAY_TRAILER
DAY_EDGE_CHARS = "．・、,-　 "
SEA_DAY = r"(?iU)海上|巡遊|巡航|at\s*sea"
DATE_CELL = r"(?U)([A-Z][a-z]{2}\s+\d{1,2},\s*\d{4})"
CLAIMED_COUNT = r"(?iU)([\d,]+)\s+Matched\s+Sailing"
ITINERARY_SUFFIX = r"(?U)\s*Itinerary Details\s*$"
SCRIPT_PUSH_TEXT = r'(?U)self\.__next_f\.push\(\[1,\s*("[^"\\]*+(?:\\.[^"\\]*+)*+")'
ITEM_START = r'(?U)"item":\s*(?=\{"id":\s*\d+,\s*"name":)'
PAGE_META = r'(?U)\{"total":\s*(\d+),\s*"currentPage":\s*\d+,\s*"limit":\s*(\d+)'
BLOCKED_TITLES = ("just a moment", "attention required", "access denied")
BLOCKED_MARKERS = (
    "challenges.cloudflare.com",
    "cf-chl",
    "_cf_chl_opt",
    "Performing security verification",
)

# --- Fixed values: (shape, format) of dates, tried in this order after ISO -----
DATE_FORMATS = (
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{4,}-\d{4}$", "d-MMMM-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
)

# --- Fixed values: per-source constants --------------------------------------
ICRUISE_BASE = "https://www.icruise.com"
ICRUISE_PAGE_LIMIT = 25
EXPEDIA_CABINS = ("Inside", "Outside", "Balcony", "Suite")
EXPEDIA_URL = "https://bookus.expediacruises.com/swift/cruise/package/{id}?siid=1095905&lang=1"
EXPEDIA_NOTE = "各房型最低價（每人）"
CRUISEDIRECT_NOTE = "各房型最低價（每人，含稅費）"
ASIAYO_URL = "https://asiayo.com/zh-tw/cruise/item/{id}/?activityStartDate={date}"
ASIAYO_NOTE = "行程總價（每人，2 人一室起）"
BWT_URL = "https://www.bwt.com.tw/Tour/{code}"
BWT_NOTE = "團費（每人，2 人一室）"
BWT_DEPARTURE = "基隆港"
BWT_NO_PRICE = 99999999
STREAM_PREFIX = "data: "
STREAM_END = "[DONE]"

# --- Fixed values: exchange-rate providers, in order -------------------------
FX_PRIMARY = "open.er-api.com"
FX_FALLBACK = "tw.rter.info"
FX_MANUAL = "--fx-rate（手動指定）"

# --- Fixed values: output wording --------------------------------------------
ON_REQUEST = "洽詢報價"
NO_VALUE = "—"
MONEY_SYMBOLS = {"TWD": "NT$", "USD": "US$"}
UNMAPPED_WARNING = "這些船名沒有英文對照，無法跨來源比價："
LIST_MARK = "、"
CSV_HEADERS = (
    "出發日期",
    "出發港口",
    "目的港口",
    "郵輪名",
    "船公司",
    "航行天數",
    "最低價格",
    "幣別",
    "台幣價格",
    "匯率",
    "價格說明",
    "停靠港",
    "來源",
    "其他來源報價",
    "資料狀態",
    "連結",
)
CSV_FRESH = "最新"
CSV_MARK = "\ufeff"
CSV_STALE = ("沿用 ", " 資料")
DISPLAY_ZONE = "Asia/Taipei"
