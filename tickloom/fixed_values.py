"""Fixed values that results depend on; they must stay as they are."""

# Tracked coin names and their tickers.
TICKERS = {
    "bitcoin": "BTC",
    "ethereum": "ETH",
    "solana": "SOL",
    "cardano": "ADA",
    "ripple": "XRP",
    "polkadot": "DOT",
    "avalanche-2": "AVAX",
    "dogecoin": "DOGE",
}

# Substrings that count as a mention of a ticker in a lower-cased title.
MENTION_PATTERNS = {
    "BTC": ("btc", "bitcoin"),
    "ETH": ("eth", "ethereum"),
    "SOL": ("sol", "solana"),
    "ADA": ("ada", "cardano"),
    "XRP": ("xrp", "ripple"),
    "DOT": ("dot", "polkadot"),
    "AVAX": ("avax", "avalanche"),
    "DOGE": ("doge", "dogecoin"),
}

# Default watch list, completeness list, stream age limit.
WATCH_LIST = ("BTC", "ETH", "SOL", "ADA", "XRP")
EXPECTED_COINS = "bitcoin,ethereum"
STREAM_MAX_DELAY_MINUTES = 10

# Text that stands for NULL inside a surrogate key.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"

# What a coin-day gets when a community source has no row for it.
MISSING_INDEX_VALUE = 50
MISSING_INDEX_CLASS = "Neutral"

# Placeholder posts used when the feed returns nothing.
FALLBACK_POSTS = (
    ("bitcoin", "Bitcoin market discussion fallback record", "https://www.reddit.com/r/Bitcoin/"),
    ("ethereum", "Ethereum market discussion fallback record", "https://www.reddit.com/r/ethereum/"),
)
