"""Fixed values that results depend on: word lists, weights and patterns, tested as substrings of lower-cased text."""

# --- fixed values ----------------------------------------------------------------------------------------------------

LINK_URL_WEIGHTS = [("investor.", 50), ("investors.", 50), ("ir.", 50), ("/investor", 40), ("/investors", 40), ("/investor-relations", 45), ("/investorrelations", 45), ("/shareholder", 35), ("/ir", 30)]
LINK_TEXT_WEIGHTS = [("investor relations", 40), ("investors", 30), ("investor", 25), ("shareholder", 20), ("financial information", 20), ("stock information", 20), ("ir", 15)]
LINK_DOCUMENT_WEIGHTS = [("annual report", 30), ("10-k", 35), ("10-q", 35), ("8-k", 35), ("proxy", 25), ("earnings", 25), ("sec filing", 30), ("presentation", 20), ("transcript", 20)]
DOCUMENT_WEIGHTS = [("annual report", 5), ("10-k", 6), ("10-q", 6), ("8-k", 6), ("proxy", 4), ("earnings", 4), ("financial", 3), ("investor", 3), ("sec filing", 5), ("presentation", 3), ("transcript", 3), ("quarterly", 4), ("results", 3)]
SITE_URL_WEIGHTS = [
    *LINK_URL_WEIGHTS, ("investorrelations.", 50), ("shareholder.", 45), ("/about/investors", 40), ("/en/investors", 40), ("/financial", 25), ("/sec-filings", 25), ("/investors.html", 35), ("/investor.html", 35), ("/ir.html", 30),
    ("q4cdn.com", 45), ("q4inc.com", 45), ("/earnings", 20), ("/reports", 15), ("/governance", 15),
]
SITE_TEXT_WEIGHTS = [
    ("investor relations", 40), ("investor information", 35), ("shareholder information", 35), ("investors", 30), ("investor", 25), ("shareholder", 20), ("financial information", 20), ("stock information", 20), ("sec filings", 25),
    ("annual reports", 20), ("quarterly reports", 20), ("earnings", 15), ("financial results", 20), ("corporate governance", 15), ("ir", 15), ("financials", 10), ("reports", 8), ("governance", 8),
]
DOCUMENT_TYPES = [
    ("10-K Annual Report", ["10-k", "form 10-k", "form10-k", "10k annual"]),
    ("10-Q Quarterly Report", ["10-q", "form 10-q", "form10-q", "10q quarter"]),
    ("8-K Current Report", ["8-k", "form 8-k", "form8-k"]),
    ("Proxy Statement", ["proxy statement", "proxy", "def 14a", "def14a"]),
    ("Press Release", ["press release", "earnings release"]),
    ("CFO Commentary", ["cfo commentary", "cfo comment"]),
    ("Audio Webcast", ["webcast", "audio", ".mp3", "call.mp3"]),
    ("Transcript", ["transcript", "call transcript", "earnings call"]),
    ("Presentation", ["presentation", "slides", "deck", "investor deck"]),
    ("Revenue Trend", ["revenue trend", "quarterly revenue"]),
    ("Supplemental Data", ["supplemental", "data table", "supplemental data"]),
    ("Annual Report", ["annual report"]),
    ("Excel Data", [".xlsx", ".xls"]),
]
FILE_NAME_TYPES = [("10-K Annual Report", ["10-k", "annual"]), ("10-Q Quarterly Report", ["10-q", "quarterly"]), ("Proxy Statement", ["proxy"]), ("Press Release", ["press", "earnings"]), ("Presentation", ["presentation"])]
OTHER_FILE = "Other PDF Document"
QUARTERLY_PRIORITY = [("Press Release", 1), ("10-Q Quarterly Report", 2), ("Presentation", 3), ("CFO Commentary", 4), ("Transcript", 5), ("Excel Data", 6)]
FILE_EXTENSIONS = [".pdf", ".xlsx", ".xls", ".pptx", ".ppt", ".docx", ".doc", ".csv", ".mp3", ".mp4"]
LINKED_EXTENSIONS = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".csv"]
DELIVERY_PATTERNS = [r"\.q4cdn\.com/.*/files/", r"\.q4cdn\.com/.*/doc_", r"\.cloudfront\.net/", r"/static-files/[a-f0-9\-]{30,}", r"/files/doc_", r"/_assets/.*/", r"/doc_financials/", r"/doc_downloads/", r"/doc_earnings/"]
MIME_EXTENSIONS = [
    ("application/pdf", ".pdf"), ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".xlsx"), ("application/vnd.ms-excel", ".xls"), ("application/vnd.openxmlformats-officedocument.presentationml.presentation", ".pptx"),
    ("application/vnd.ms-powerpoint", ".ppt"), ("audio/mpeg", ".mp3"), ("video/mp4", ".mp4"), ("text/csv", ".csv"),
]
BAD_SITE_WORDS = ["smartphone", "iphone", "product", "shop", "/careers"]
GOOD_SITE_WORDS = ["investor", "ir.", "shareholders", "/investor"]
SECTION_PRIORITY = ["sec filing", "10-k", "10-q", "financial", "annual report", "quarterly", "earnings", "investor"]
SECTION_WORDS = ["financial", "investor", "earning", "report", "filing", "sec", "presentation", "event", "news", "press", "annual", "quarterly", "result", "document", "library", "information"]
SECTION_STOPS = ["contact", "email alert", "subscribe", "rss", "faq", "help", "cookie", "privacy", "terms", "accessibility", "sitemap"]
INVESTOR_HOSTS = ["investor.", "investors.", "ir.", "investorrelations.", "shareholder.", "q4cdn.com", "q4inc.com"]
INVESTOR_PHRASES = ["investor relations", "investor", "sec filings", "financial results", "earnings", "stock information"]
IGNORED_HOSTS = ["cnbc.com", "facebook", "twitter", "linkedin", "youtube", "instagram", "tipranks", "seekingalpha", "marketwatch", "yahoo", "google", "reuters", "bloomberg", "morningstar", "zacks", "fool.com", "investopedia"]
COMPANY_SUFFIXES = ["inc", "corp", "company", "corporation", "ltd", "llc", "the", "group", "co"]
SITE_URL_HINTS = ["investor", "ir.", "/investors", "/investor-relations"]
SITE_TEXT_HINTS = ["investor", "ir", "relations"]
CANDIDATE_SITES = [
    "https://investor.{root}", "https://investors.{root}", "https://ir.{root}", "https://investorrelations.{root}", "https://shareholder.{root}",
    "https://www.{root}/investor-relations", "https://www.{root}/investors", "https://www.{root}/investor", "https://www.{root}/about/investors", "https://www.{root}/en/investors", "https://www.{root}/en/investors.html",
    "https://www.{root}/investors.html", "https://www.{root}/ir", "https://www.{root}/shareholder", "https://s2.q4cdn.com/{ticker}/", "https://ir.about{base}.com", "https://{base}investor.com", "https://investor{base}.com", "https://ir{base}.com",
]
OTHER_SITES = ["{base}investor.com", "investor{base}.com", "ir{base}.com", "about{base}.com"]
PENALTY_WORDS = ["login", "signin", "signup", "register", "cart", "checkout", "privacy", "terms", "cookie", "subscribe", "newsletter"]
DOCUMENT_BONUS = ["pdf", "download", "document", "file", "report", "filing"]
TABLE_BONUS = ["data", "table", "financials", "statistics", "metrics"]
INTENT_KEYWORDS = ["investor", "relations", "financial", "earnings", "documents", "reports", "sec", "filing", "10-k", "10-q", "8-k", "proxy", "annual", "quarterly", "presentation", "transcript"]
INTENT_VARIANTS = [(["ir", "investor relations"], ["investor", "relations", "ir"]), (["document"], ["documents", "files", "pdf"]), (["financial"], ["financial", "finance", "money"])]
INTENT_TARGETS = [
    ("documents", ["document", "report", "filing", "pdf", "presentation", "transcript"]),
    ("tables", ["table", "data", "financial", "numbers", "metrics"]),
    ("content", ["information", "content", "text", "details"]),
]
INVESTOR_INTENT = ["investor", "relations", "ir", "financial", "documents", "earnings", "sec", "filing"]
STOP_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by"]
ACTION_WORDS = [("find", ["find", "locate", "get", "retrieve", "search"]), ("extract", ["extract", "parse", "scrape", "collect"]), ("download", ["download", "fetch", "grab"]), ("analyze", ["analyze", "understand", "summarize"])]
TARGET_PATTERNS = [
    ("documents", "(document|pdf|file|report|form|filing)"), ("links", "(link|url|page|website)"), ("tables", "(table|data|spreadsheet|financials?)"), ("content", "(content|text|article|information)"), ("images", "(image|photo|picture|graphic)"),
]
DOMAIN_WORDS = [
    ("investor_relations", ["investor", "annual report", "quarterly", "earnings", "sec filing", "10-k", "10-q"]),
    ("news", ["news", "article", "press release", "announcement"]),
    ("products", ["product", "catalog", "pricing", "specifications"]),
    ("contact", ["contact", "email", "phone", "address"]),
]
COMPLEX_WORDS = ["if", "when", "unless", "provided that"]
REFINED_INTENTS = [
    ("url", ["investor", "ir.", "/investors"], "Navigate to investor relations section to find financial documents and reports"),
    ("url", ["/earnings", "/financial", "/reports"], "Access financial reports and earnings information"),
    ("text", ["10-k", "10-q", "8-k", "annual report"], "Download SEC filing or annual report document"),
    ("text", ["presentation", "transcript"], "Access investor presentation or earnings call transcript"),
    ("url", ["pdf", "download"], "Download document file"),
]
REFINED_OTHER = "Explore link for investor relations content and financial documents"
HEURISTIC_INTENTS = [
    ("documents", ["investor", "annual", "report", "filing"], "Navigate to find and download financial documents related to: "),
    ("documents", ["sec", "10-k", "10-q"], "Access SEC filings to find required documents for: "),
    ("tables", ["data", "financial", "metric", "stat"], "Find and extract financial data tables for: "),
]
PAGE_TYPES = [("investor_relations", ["investor relations", "shareholder", "sec filing"]), ("financial_documents", ["annual report", "10-k", "10-q", "financial statement"])]
METADATA_KEYS = ["description", "keywords", "author", "viewport", "og:title", "og:description", "og:image", "og:url", "og:type", "twitter:card", "twitter:title", "twitter:description"]
NAVIGATION_CLASSES = ["nav", "menu", "header", "footer", "breadcrumb"]
DATE_PATTERNS = [r"Q([1-4])\s*20([12]\d)", r"20([12]\d)\s*Q([1-4])", r"FY\s*(\d{2})", r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+\d{1,2},?\s+20[12]\d"]
AMOUNT = r"[\s:]*\$?([\d,]+(?:\.[\d]+)?)\s*(?:million|billion|m|b)?"
REVENUE_NAMES = ["revenue", "total revenue", "net revenue"]
PROFIT_NAMES = ["net income", "profit", "earnings"]
HEX_NAME = r"[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"
HEX_WORD = r"\b[a-f0-9]{8,}\b"
FULL_YEAR = r"20[12]\d"
FISCAL_YEAR = r"fy\s*(\d{2,4})"
LATER_YEARS = [r"/(20\d{2})/", r"[-_](20\d{2})[.\-_]", r"\d{10}-(\d{2})-\d{6}", r"(?i)(?:[1-4]q|q[1-4])\s*(\d{2})(?!\d)", r"(?<!\d)(\d{2})\s*$"]
QUARTER = r"[q\-]([1-4])(?:\s|q|$)"
BRACKETED_TICKER = r"\(([A-Z]{1,5})\)"
