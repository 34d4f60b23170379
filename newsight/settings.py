"""Default parameters. Every operator takes these as arguments; nothing here acts.

The block below states fixed values: results only agree with the daily job this
engine replaces if these lists, limits and formats are used as they stand.
"""

# ---- fixed values -----------------------------------------------------------

# query parameters dropped before two URLs are compared (case-sensitive)
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
    "ref", "fbclid", "gclid",
]

# hosts that are never fetched (substring of the lower-cased netloc)
BLOCKED_DOMAINS = [
    "mtltimes.ca", "themalaysianreserve.com", "keloland.com", "torontolife.com",
    "passportmagazine.com", "la1ere.franceinfo.fr", "msn.com",
]

# hosts read with the fr-CA locale (substring of the lower-cased netloc)
FRENCH_DOMAIN_PATTERNS = [
    ".qc.ca", ".quebec", "radio-canada.ca", "lapresse.ca", "lesoleil.com",
    "journaldequebec.com", "ledevoir.com", "ici.radio-canada.ca", "tvanouvelles.ca",
]
FRENCH_LOCALE = "fr-CA"
OTHER_LOCALE = "en-US"

REDIRECT_HOST = "news.google.com"
DEFAULT_SEARCH_SOURCE = "serpapi"

SITEMAP_NAMESPACES = [
    "http://www.sitemaps.org/schemas/sitemap/0.9",
    "https://www.sitemaps.org/schemas/sitemap/0.9",
]
NEWS_NAMESPACES = [
    "http://www.google.com/schemas/sitemap-news/0.9",
    "https://www.google.com/schemas/sitemap-news/0.9",
]

RECENCY_HOURS = 24

RELEVANCE_BATCH_SIZE = 25
RELEVANCE_THRESHOLD = 79.5
RELEVANT_COUNT_FLOOR = 50
RELEVANCE_CATEGORIES = [
    "HIGHLY_RELEVANT", "MODERATELY_RELEVANT", "LOW_RELEVANCE", "NOT_RELEVANT",
]
ERROR_CATEGORY = "ERROR"
UNMATCHED_REASONING = "No matching result from Gemini"
MAX_ATTEMPTS = 5

FETCH_BATCH_SIZE = 10
FETCH_REFUSED = [403, 429]
MIN_CONTENT_CHARS = 100
ERROR_TEXT_CHARS = 50

PHRASE_MIN_CHARS = 20
PHRASE_MAX_CHARS = 350
PHRASE_BATCH_SIZE = 16

SIMILARITY_THRESHOLD = 0.85

TOPIC_CONTENT_CHARS = 400
TOPIC_BATCH_SIZE = 8

WINDOW_TOKENS = 400
WINDOW_STRIDE = 350

SUMMARY_CONTENT_CHARS = 9000
SUMMARY_RETRY_CHARS = 5000
SUMMARY_MAX_CHARS = 500
ELLIPSIS = "..."

PERCEPTION_FORMS = {
    "negative": ["negative", "négative", "negatif", "négatif"],
    "neutre": ["neutral", "neutralle", "neutre"],
    "positive": ["positive", "positif"],
}
QUEBEC_VALUES = ["oui", "non"]
FLAG_VALUES = ["0", "1"]
DROPPED_FLAG = "1"

AUDIT_SOURCE_CHARS = 50
AUDIT_TITLE_CHARS = 120
AUDIT_SUMMARY_CHARS = 150

# topic label -> French display label
TOPIC_LABELS_FR = {
    "arts, culture, entertainment and media": "Arts, culture, divertissement et médias",
    "conflict, war and peace": "Conflit, guerre et paix",
    "crime, law and justice": "Criminalité, droit et justice",
    "disaster, accident and emergency incident": "Désastres et accidents",
    "economy, business and finance": "Économie et finances",
    "education": "Éducation",
    "environment": "Environnement",
    "health": "Santé",
    "human interest": "Intérêt humain",
    "labour": "Travail",
    "lifestyle and leisure": "Style de vie et loisirs",
    "politics": "Politique",
    "religion": "Religion et croyance",
    "science and technology": "Science et technologie",
    "society": "Société",
    "sport": "Sport",
    "weather": "Météo",
}

# multi-label score -> exported column
LABEL_COLUMNS = {
    "tourism event/attraction": "Attrait",
    "hotel/lodging": "Hebergement",
    "restaurant": "Restaurant",
}

# offsets in minutes of the zone names allowed in mail-style dates
MAIL_ZONE_MINUTES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360,
    "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

# forms of the absolute dates of search results, in the order in which they are tried
SEARCH_DATE_SHAPES = [
    "MMM d, yyyy, hh:mm:ss a",
    "MMM d, yyyy, hh:mm a",
    "MMM d, yyyy",
    "MMMM d, yyyy, hh:mm:ss a",
    "MMMM d, yyyy, hh:mm a",
    "MMMM d, yyyy",
    "MM/dd/yyyy hh:mm a",
    "MM/dd/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd MMM yyyy",
    "dd MMMM yyyy",
]

# prompt texts around the numbered article list and around one article
BATCH_PROMPT_HEAD = (
    "Analyze the relevance of these {n} articles to Quebec City and the Capitale-Nationale region."
)
BATCH_PROMPT_ITEM = '**Article {number} (ID: "{id}"):**\nTitle: {title}\nURL: {url}'
BATCH_PROMPT_TAIL = (
    "Return a JSON array with analysis for each article, maintaining the article_id order."
)
ARTICLE_PROMPT = (
    "Title: {title}\n\nArticle:\n{content}\n\n"
    "Analyze this article from Destination Québec's perspective."
)

# ---- engine parameters (ours) -----------------------------------------------

# An article's ordinal is its source number and its position inside the payload. Search pages
# are numbered after every feed. Numbers beyond these bits stop the job.
ITEM_ORD_BITS = 22
SOURCE_ORD_BITS = 41
SEARCH_SOURCE_BASE = 1 << 40
SEARCH_PAGE_BITS = 14
SEARCH_ORD_BITS = 26
