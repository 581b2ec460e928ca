"""Domain constants.

Fixed values: these must equal the source system's configuration for results
to match (pair list, currencies, exchanges, trader types, event types,
lookback windows, hour profile, pair spread bands and volatilities, expected
trader shares, test thresholds).  Stated plainly, in natural order.
"""

# ---------------------------------------------------------------- fixed values
CURRENCY_PAIRS = ["ECR/MRT", "ECR/LCR", "ECR/AMC", "MRT/LCR", "MRT/AMC", "LCR/AMC"]
CURRENCIES = ["ECR", "MRT", "LCR", "AMC"]
EXCHANGES = ["Earth_FX_Hub", "Mars_Central_Exchange", "Lunar_Trading_Post", "Asteroid_Belt_Hub"]
TRADER_TYPES = ["institutional", "retail", "mining_corp", "government"]
EVENT_TYPES = ["SOLAR_STORM", "TRADE_TARIFF", "OXYGEN_CRISIS", "MINING_STRIKE",
               "POLICY_CHANGE", "SUPPLY_SHOCK"]

# candle grain -> late-data lookback in minutes
LOOKBACK_MINUTES = {"1min": 5, "5min": 15, "1h": 120, "1d": 1440}

# UTC hour 0..23 -> volume multiplier; peak when >= 1.2
HOUR_VOLUME_PROFILE = [0.3, 0.2, 0.2, 0.2, 0.3, 0.4, 0.6, 0.8, 1.0, 1.2, 1.3, 1.4,
                       1.5, 1.5, 1.4, 1.3, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.3]
PEAK_HOUR_MULTIPLIER = 1.2

# pair -> (min_spread_bps, max_spread_bps, annual volatility, base price, typical trade size)
PAIR_CONFIG = {
    "ECR/MRT": (5, 20, 0.15, 2.45, 10000.0),
    "ECR/LCR": (3, 15, 0.08, 1.12, 15000.0),
    "ECR/AMC": (8, 30, 0.22, 0.87, 5000.0),
    "MRT/LCR": (5, 18, 0.12, 0.46, 12000.0),
    "MRT/AMC": (7, 25, 0.18, 0.36, 8000.0),
    "LCR/AMC": (6, 22, 0.14, 0.78, 9000.0),
}

# currency_pairs seed: base, quote, symbol, min/max trade size, tick size,
# active, base price estimate, avg daily volatility, primary exchange, name
PAIR_SEED_ROWS = [
    ("ECR", "MRT", "ECR/MRT", "0.01", "1000000.00", "0.0001", True, "2.45", "0.15",
     "Mars_Central_Exchange", "Earth Credits to Mars Tokens"),
    ("ECR", "LCR", "ECR/LCR", "0.01", "1000000.00", "0.0001", True, "1.12", "0.08",
     "Lunar_Trading_Post", "Earth Credits to Lunar Credits"),
    ("ECR", "AMC", "ECR/AMC", "0.01", "1000000.00", "0.0001", True, "0.87", "0.22",
     "Asteroid_Market", "Earth Credits to Asteroid Mining Coins"),
    ("MRT", "LCR", "MRT/LCR", "0.01", "1000000.00", "0.0001", True, "0.46", "0.12",
     "Mars_Central_Exchange", "Mars Tokens to Lunar Credits"),
    ("MRT", "AMC", "MRT/AMC", "0.01", "1000000.00", "0.0001", True, "0.36", "0.18",
     "Asteroid_Market", "Mars Tokens to Asteroid Mining Coins"),
    ("LCR", "AMC", "LCR/AMC", "0.01", "1000000.00", "0.0001", True, "0.78", "0.14",
     "Lunar_Trading_Post", "Lunar Credits to Asteroid Mining Coins"),
]

# economic calendar seed: id, name, type, days after base date, currencies, impact, description
CALENDAR_SEED_ROWS = [
    ("SOLAR_STORM_001", "Major Solar Storm Warning", "SOLAR_STORM", 3, ["MRT", "AMC"], "HIGH",
     "Predicted solar storm may disrupt Mars-Asteroid communications"),
    ("TARIFF_001", "Earth Import Tariff Adjustment", "TRADE_TARIFF", 7, ["ECR", "MRT", "LCR"], "MEDIUM",
     "Earth Council announces 5% tariff increase on Mars imports"),
    ("MINING_STRIKE_001", "Asteroid Miners Union Strike", "MINING_STRIKE", 10, ["AMC"], "HIGH",
     "AMC production expected to drop 30% during strike period"),
    ("POLICY_001", "Lunar Central Bank Rate Decision", "POLICY_CHANGE", 14, ["LCR", "ECR"], "MEDIUM",
     "Lunar CB expected to raise interest rates by 25 bps"),
    ("SUPPLY_SHOCK_001", "Mars Water Ice Discovery", "SUPPLY_SHOCK", 21, ["MRT"], "CRITICAL",
     "Major water ice discovery may boost Mars economy significantly"),
]

# event severity 1..5 -> expected impact text
IMPACT_LABELS = {
    1: "Minor market disruption expected",
    2: "Moderate volatility anticipated",
    3: "Significant market impact likely",
    4: "Major disruption to trading operations",
    5: "Critical event with severe market consequences",
}

EXPECTED_TRADER_SHARE = {"institutional": 0.40, "retail": 0.35, "mining_corp": 0.15, "government": 0.10}
TRADER_SHARE_TOLERANCE = 0.05

PRICE_MIN, PRICE_MAX = 0.0001, 1000000
FRESHNESS_WARN_MINUTES, FRESHNESS_ERROR_MINUTES = 5, 15
TICKS_PER_SECOND_PER_PAIR = 10
TICK_RATE_TOLERANCE = 0.1
MAX_TICK_GAP_MS = 200
BOUNDARY_RADIUS_SECONDS = 5
MINUTE_VOLATILITY_THRESHOLD = 0.1
CORRELATION_THRESHOLD = 0.1         # |corr| above which two pairs count as correlated
REALIZED_VOL_WINDOW = 100           # prices kept in the rolling history
ANNUALIZATION_PERIODS = 252 * 24    # sqrt factor for realised volatility
STREAM_ROLL_SECONDS = 30
# ----------------------------------------------------------- end fixed values

INTERVALS = ("1min", "5min", "1h", "1d")
