"""Fixed values that must equal the behaviour being reproduced.

Everything in the "fixed values" block is stated plainly and in its natural
order; operators take these as defaults and accept other lists as parameters.
"""

# ---------------------------------------------------------------------------
# Fixed values (must match for equal results)
# ---------------------------------------------------------------------------

# Sentiment classes, in model output index order.
SENTIMENT_LABELS = ["negative", "neutral", "positive"]

# Emotion classes, in model output index order.
EMOTION_LABELS = ["anger", "disgust", "fear", "joy", "neutral", "sadness", "surprise"]

# Keywords whose presence (case-insensitive substring) raises toxicity.
TOXIC_KEYWORDS = ["hate", "worst", "terrible", "awful", "horrible", "scam", "fraud"]

# Dimension spines.
CITIES = ["Dubai", "Abu Dhabi", "Sharjah", "Ajman", "Ras Al Khaimah", "Fujairah", "Umm Al Quwain"]
GEO_REPORT_CITIES = ["Dubai", "Abu Dhabi", "Sharjah", "Ajman"]
PRODUCTS = ["Credit Card", "Personal Loan", "Mortgage", "Savings Account", "Investment", "Insurance"]
CHANNELS = ["Mobile App", "Website", "Branch", "Call Center", "Social Media"]
PLATFORMS = ["twitter", "reddit", "instagram", "facebook"]
DEVICES = ["iOS", "Android", "Web", "Mobile Web", "Desktop"]

# Thresholds and limits.
HIGH_CHURN_THRESHOLD = 0.7
MAX_SCORABLE_CHARS = 5000
MAX_BATCH_TEXTS = 100
METRICS_TTL_HOURS = 24
DEFAULT_WINDOW = "60 seconds"
RECENT_POINTS = 50
PREVIEW_CHARS = 50
STORE_DECIMALS = 3
LABEL_DECIMALS = 2
CHANNEL_AXIS_DEFAULT = 100

# Segment dimensions, in fan-out order, and their storage-key prefix.
SEGMENT_DIMS = [("geo", "city"), ("product", "product"), ("channel", "channel"),
                ("platform", "platform")]
OVERALL_DIM = "overall"
METRIC_KEY_PREFIX = "sentiment"

# Removed-content markers for comment bodies and deleted authors.
REMOVED_BODIES = ["", "[deleted]", "[removed]"]
DELETED_AUTHOR = "[deleted]"

# Retention in days.
RETENTION_DAYS = {"raw": 7, "processed": 30, "history": 90}

# Latency histogram bounds (seconds) used by A10 by default.
LATENCY_BOUNDS_SEC = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

# ---------------------------------------------------------------------------
# Fixture lexicon for the Column scorer (driver tables carry invented prose).
# ---------------------------------------------------------------------------
FIXTURE_NEGATIVE_WORDS = ["trash", "pathetic", "idiot", "worthless", "disgusting", "stupid",
                          "clown", "scum", "loser", "moron"]
FIXTURE_POSITIVE_WORDS = ["with", "from", "this"]
