"""The results depend on them, so they are stated as they are."""

# Size bands as published (en dash) and their midpoints in USD;
# the open-ended band counts with its floor.
BAND_MIDPOINTS = {
    "1K–15K": 8000,
    "15K–50K": 32500,
    "50K–100K": 75000,
    "100K–250K": 175000,
    "250K–500K": 375000,
    "500K–1M": 750000,
    "1M–5M": 3000000,
    "5M–25M": 15000000,
    "25M–50M": 37500000,
    "50M+": 50000000,
}

# Long sector names and the short ones used in reports.
SECTOR_LABELS = {
    "Information Technology": "Tech",
    "Financials": "Financials",
    "Health Care": "Health Care",
    "Consumer Discretionary": "Consumer Disc",
    "Communication Services": "Comm Services",
    "Industrials": "Industrials",
    "Consumer Staples": "Staples",
    "Energy": "Energy",
    "Utilities": "Utilities",
    "Real Estate": "Real Estate",
    "Materials": "Materials",
}

# Market capitalisation in USD billions per watched symbol.
MARKET_CAPS = {
    "NVDA": 3300, "AAPL": 3400, "MSFT": 3100, "AVGO": 780, "CRM": 290,
    "ORCL": 430, "ADBE": 230, "AMD": 260, "CSCO": 200, "INTC": 130,
    "JPM": 620, "BRK.B": 1000, "V": 570, "MA": 460, "BAC": 310,
    "WFC": 210, "GS": 170, "MS": 170, "C": 130, "BLK": 150,
    "LLY": 780, "JNJ": 380, "UNH": 470, "ABBV": 310, "MRK": 300,
    "TMO": 220, "AMGN": 170, "PFE": 160, "ABT": 200, "DHR": 180,
    "AMZN": 2000, "TSLA": 780, "HD": 360, "MCD": 210, "NKE": 120,
    "LOW": 150, "SBUX": 110, "BKNG": 130, "TJX": 130, "CMG": 90,
    "GOOGL": 2200, "META": 1400, "NFLX": 300, "DIS": 180, "TMUS": 230,
    "VZ": 180, "CMCSA": 170, "T": 130, "WBD": 25, "CHTR": 55,
    "CAT": 180, "GE": 180, "RTX": 150, "UNP": 140, "HON": 140,
    "LMT": 120, "UPS": 120, "DE": 110, "BA": 120, "FDX": 70,
    "WMT": 650, "COST": 400, "PG": 390, "KO": 280, "PEP": 230,
    "PM": 180, "MDLZ": 95, "MO": 90, "TGT": 70, "CL": 80,
    "XOM": 490, "CVX": 280, "COP": 135, "SLB": 65, "EOG": 75,
    "MPC": 55, "PSX": 60, "VLO": 45, "OXY": 55, "HAL": 30,
    "NEE": 150, "DUK": 85, "SO": 95, "CEG": 80, "D": 45,
    "AEP": 55, "SRE": 55, "PCG": 45, "EXC": 40, "VST": 45,
    "PLD": 110, "AMT": 95, "EQIX": 75, "WELL": 75, "SPG": 60,
    "CCI": 50, "PSA": 55, "O": 50, "DRE": 25, "CSGP": 30,
    "LIN": 220, "FCX": 70, "SHW": 95, "APD": 60, "ECL": 65,
    "NEM": 55, "DOW": 40, "NUE": 35, "CTVA": 45, "VMC": 35,
}

# The watchlist is the set of weighted symbols.
WATCHLIST = tuple(MARKET_CAPS)

# Tickers that stand for "none".
NO_TICKER = ("", "--", "N/A")

# Statutory disclosure window and crawl lookback, in days.
DISCLOSURE_WINDOW_DAYS = 45
LOOKBACK_DAYS = 45

# Bar interval, fallback sector and quote page.
BAR_INTERVAL = "1h"
OTHER_SECTOR = "Other"
QUOTE_URL = "https://finance.yahoo.com/quote/"
