"""They must be exactly these for results to agree with published ones."""

# Limits of a usable review.
MIN_CHARS = 100
MIN_PRICE = 4
MAX_PRICE = 500

# Curation.
SEED = 42
BINS = 16
CAP = 10_000
VAL_SIZE = 2_000
TEST_SIZE = 2_000

# Text of one review, and of one prompt.
YEAR = r"(19[3-9]\d|20[0-2]\d)"
DEFAULT_FIELDS = ("vintage", "variety", "country", "province", "region", "note")
QUESTION = "How much does this bottle of wine cost, to the nearest dollar?"
PREFIX = "Price is $"
CUTOFF = 160
MAX_LENGTH = 256

# Structured readings of a note.
DIMENSIONS = ("fruit", "oak", "tannin", "acidity", "body", "finish")
LOWEST_SCORE = 0
HIGHEST_SCORE = 3
REPLY_TOKENS = 300
ATTEMPTS = 3
DAILY_TOKENS = 200_000

# Numbers inside model replies.
NUMBER = r"[-+]?\d*\.\d+|\d+"
NUMBER_WITH_COMMAS = r"[-+]?\d[\d,]*\.?\d*"
HIGHEST_GUESS = 1000.0

# Scoring.
EVAL_SIZE = 2_000

# Feature tables.
METADATA = ("variety", "country", "province")
NUMERIC = ("vintage", "note_length", "word_count")
MIN_CATEGORY = 20
MIN_DF = 3
MAX_FEATURES = 40_000
LSA_COMPONENTS = 200
FOREST_TREES = 200
MIN_LEAF = 2
RIDGE_ALPHA = 1.0

# Retrieval.
CONTEXT_K = 5
PRICE_K = 8
SAMPLE_SIZE = 2_000
CONTEXT_HEADING = "Here are tasting notes for wines whose prices are known:\n"

# Listings.
SKIPPED_ELEMENTS = ("script", "style", "nav", "footer", "header", "form")
ARTICLE_CHARS = 12_000
MIN_NOTE = 40
THRESHOLD = 15.0
BLEND_ROWS = 150
