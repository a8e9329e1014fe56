"""Fixed values. These must equal the values the original pipeline used, so they are stated
verbatim, in their original order. Everything derived from them (dialect rewrites, lookup maps)
is built from these lists in code, never edited by hand.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (pack-quantity extraction): patterns are tried in this order; the first pattern
# that matches anywhere in the lower-cased text wins.
# ---------------------------------------------------------------------------------------------
IPQ_PATTERNS = [
    r'(\d+(?:\.\d+)?)\s*(kg|kilogram|kilograms)',
    r'(\d+(?:\.\d+)?)\s*(g|gram|grams)',
    r'(\d+(?:\.\d+)?)\s*(mg|milligram|milligrams)',
    r'(\d+(?:\.\d+)?)\s*(l|liter|liters|litre|litres)',
    r'(\d+(?:\.\d+)?)\s*(ml|milliliter|milliliters|millilitre|millilitres)',
    r'(\d+(?:\.\d+)?)\s*(m|meter|meters|metre|metres)',
    r'(\d+(?:\.\d+)?)\s*(cm|centimeter|centimeters|centimetre|centimetres)',
    r'(\d+(?:\.\d+)?)\s*(mm|millimeter|millimeters|millimetre|millimetres)',
    r'pack\s+of\s+(\d+)',
    r'(\d+)\s*pack',
    r'(\d+)\s*count',
    r'(\d+)\s*pieces?',
    r'(\d+)\s*pcs',
]

# FIXED VALUES (unit dimension): unit -> (unit type, factor to the standard unit g / ml / mm / 1)
UNIT_CONVERSIONS = {
    'kg': ('weight', 1000.0),
    'kilogram': ('weight', 1000.0),
    'kilograms': ('weight', 1000.0),
    'g': ('weight', 1.0),
    'gram': ('weight', 1.0),
    'grams': ('weight', 1.0),
    'mg': ('weight', 0.001),
    'milligram': ('weight', 0.001),
    'milligrams': ('weight', 0.001),
    'l': ('volume', 1000.0),
    'liter': ('volume', 1000.0),
    'liters': ('volume', 1000.0),
    'litre': ('volume', 1000.0),
    'litres': ('volume', 1000.0),
    'ml': ('volume', 1.0),
    'milliliter': ('volume', 1.0),
    'milliliters': ('volume', 1.0),
    'millilitre': ('volume', 1.0),
    'millilitres': ('volume', 1.0),
    'm': ('length', 1000.0),
    'meter': ('length', 1000.0),
    'meters': ('length', 1000.0),
    'metre': ('length', 1000.0),
    'metres': ('length', 1000.0),
    'cm': ('length', 10.0),
    'centimeter': ('length', 10.0),
    'centimeters': ('length', 10.0),
    'centimetre': ('length', 10.0),
    'centimetres': ('length', 10.0),
    'mm': ('length', 1.0),
    'millimeter': ('length', 1.0),
    'millimeters': ('length', 1.0),
    'millimetre': ('length', 1.0),
    'millimetres': ('length', 1.0),
    'pack': ('count', 1.0),
    'count': ('count', 1.0),
    'pieces': ('count', 1.0),
    'piece': ('count', 1.0),
    'pcs': ('count', 1.0),
}

# FIXED VALUES (keywords, matched as substrings of the lower-cased text)
QUALITY_KEYWORDS = [
    'premium', 'quality', 'best', 'top', 'excellent', 'superior',
    'professional', 'luxury', 'deluxe', 'authentic', 'genuine',
    'certified', 'original', 'branded', 'high-quality',
]
DISCOUNT_KEYWORDS = [
    'discount', 'sale', 'offer', 'deal', 'save', 'off',
    'clearance', 'bargain', 'cheap', 'affordable', 'budget',
]

# FIXED VALUES (pack-quantity confidence): matched unit known / unknown; no match
IPQ_CONFIDENCE_KNOWN = 0.9
IPQ_CONFIDENCE_UNKNOWN = 0.7
IPQ_CONFIDENCE_NONE = 0.0

# FIXED VALUES (TF-IDF vocabulary): size, minimum document count, maximum document share
TFIDF_MAX_FEATURES = 100
TFIDF_MIN_DF = 5
TFIDF_MAX_DF = 0.95

# FIXED VALUES (English stop-word list of scikit-learn's text vectoriser, alphabetical, 318 words)
ENGLISH_STOP_WORDS = [
    "a", "about", "above", "across", "after", "afterwards", "again", "against",
    "all", "almost", "alone", "along", "already", "also", "although", "always",
    "am", "among", "amongst", "amoungst", "amount", "an", "and", "another",
    "any", "anyhow", "anyone", "anything", "anyway", "anywhere", "are",
    "around", "as", "at", "back", "be", "became", "because", "become",
    "becomes", "becoming", "been", "before", "beforehand", "behind", "being",
    "below", "beside", "besides", "between", "beyond", "bill", "both",
    "bottom", "but", "by", "call", "can", "cannot", "cant", "co", "con",
    "could", "couldnt", "cry", "de", "describe", "detail", "do", "done",
    "down", "due", "during", "each", "eg", "eight", "either", "eleven", "else",
    "elsewhere", "empty", "enough", "etc", "even", "ever", "every", "everyone",
    "everything", "everywhere", "except", "few", "fifteen", "fifty", "fill",
    "find", "fire", "first", "five", "for", "former", "formerly", "forty",
    "found", "four", "from", "front", "full", "further", "get", "give", "go",
    "had", "has", "hasnt", "have", "he", "hence", "her", "here", "hereafter",
    "hereby", "herein", "hereupon", "hers", "herself", "him", "himself", "his",
    "how", "however", "hundred", "i", "ie", "if", "in", "inc", "indeed",
    "interest", "into", "is", "it", "its", "itself", "keep", "last", "latter",
    "latterly", "least", "less", "ltd", "made", "many", "may", "me",
    "meanwhile", "might", "mill", "mine", "more", "moreover", "most", "mostly",
    "move", "much", "must", "my", "myself", "name", "namely", "neither",
    "never", "nevertheless", "next", "nine", "no", "nobody", "none", "noone",
    "nor", "not", "nothing", "now", "nowhere", "of", "off", "often", "on",
    "once", "one", "only", "onto", "or", "other", "others", "otherwise", "our",
    "ours", "ourselves", "out", "over", "own", "part", "per", "perhaps",
    "please", "put", "rather", "re", "same", "see", "seem", "seemed",
    "seeming", "seems", "serious", "several", "she", "should", "show", "side",
    "since", "sincere", "six", "sixty", "so", "some", "somehow", "someone",
    "something", "sometime", "sometimes", "somewhere", "still", "such",
    "system", "take", "ten", "than", "that", "the", "their", "them",
    "themselves", "then", "thence", "there", "thereafter", "thereby",
    "therefore", "therein", "thereupon", "these", "they", "thick", "thin",
    "third", "this", "those", "though", "three", "through", "throughout",
    "thru", "thus", "to", "together", "too", "top", "toward", "towards",
    "twelve", "twenty", "two", "un", "under", "until", "up", "upon", "us",
    "very", "via", "was", "we", "well", "were", "what", "whatever", "when",
    "whence", "whenever", "where", "whereafter", "whereas", "whereby",
    "wherein", "whereupon", "wherever", "whether", "which", "while", "whither",
    "who", "whoever", "whole", "whom", "whose", "why", "will", "with",
    "within", "without", "would", "yet", "you", "your", "yours", "yourself",
    "yourselves",
]

# FIXED VALUES (error analysis): price-range edges and labels of the per-range SMAPE chart
PRICE_RANGE_EDGES = [0, 100, 500, 1000, 5000, 10000, 50000, float("inf")]
PRICE_RANGE_LABELS = ['0-100', '100-500', '500-1K', '1K-5K', '5K-10K', '10K-50K', '50K+']

# FIXED VALUES (numerics)
SMAPE_EPS = 1e-10            # added to SMAPE / percent-error denominators
MAPE_EPS = 1e-10             # added to the signed MAPE denominator
HESSIAN_CLIP = (0.001, 10.0)  # SMAPE objective hessian clip
HUBER_DELTA = 1.0
FOCAL_GAMMA = 2.0
FOCAL_ALPHA = 1.0
TARGET_SMAPE = 9.0           # ensemble target on validation

# FIXED VALUES (checkpoint retention and ingest batching)
MAX_CHECKPOINTS_TO_KEEP = 3
CHECKPOINT_TYPES = ['quick', 'full', 'minimal']
DOWNLOAD_BATCH_SIZE = 5000
DOWNLOAD_MAX_RETRIES = 3
ID_SEQUENCE_LENGTH = 128

# FIXED VALUES (meta learners): ridge grid 10^-4..10^4 (20 log-spaced), elastic net grid
# 10^-4..10^2 (20 log-spaced) x mixing values, 5 folds
RIDGE_ALPHA_RANGE = (-4.0, 4.0, 20)
ENET_ALPHA_RANGE = (-4.0, 2.0, 20)
ENET_L1_RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9]
N_FOLDS = 5
VALIDATION_SHARE = 0.1
RANDOM_STATE = 42
