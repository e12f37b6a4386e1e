"""Word lists, patterns, bounds and formats that results depend on.

Everything here must stay exactly as it is for the results to be right. The
patterns are written for the JVM regex engine, with ``(?U)`` where character
classes have to follow Unicode. All of it can be replaced through function
parameters; these are the defaults.
"""

from __future__ import annotations

# --- Fixed values: limits ---------------------------------------------------
MAX_TITLE_CHARS = 200
MAX_DESCRIPTION_CHARS = 1500
MAX_HEADER_CHARS = 300
MAX_COMPANY_CHARS = 80
REMOTE_SCOPE_CHARS = 400
ENTITY_SCOPE_CHARS = 600
HOURLY_TAIL_CHARS = 12
JOB_ID_CHARS = 16
MIN_SALARY = 20_000
MAX_SALARY = 1_000_000
FUZZY_THRESHOLD = 90
DIGEST_ITEMS = 25
MESSAGE_ITEMS = 10
DIGEST_SKILLS = 8
MESSAGE_CHARS = 4000
MIN_NEW_RECORDS = 1

# --- Fixed values: text cleaning ---------------------------------------------
ZERO_WIDTH = r"[\u200b\u200c\u200d\u2060\ufeff]"
WHITESPACE = r"(?U)[\s\x1c-\x1f]"
LOCATION_EDGE = r"^[ ,;.\-]+|[ ,;.\-]+$"
LOCATION_ACRONYMS = ["EMEA", "APAC", "LATAM", "USA", "UAE"]
UNKNOWN_SOURCE = "unknown"
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# --- Fixed values: comment feed ----------------------------------------------
LISTING_SOURCE = "fake_jobs"
COMMENT_SOURCE = "hn_hiring"
COMMENT_URL_PREFIX = "https://news.ycombinator.com/item?id="
HIRING_THREAD_PREFIX = "ask hn: who is hiring"
ROLE_WORDS = (
    r"(?iU)\b(engineer|developer|scientist|analyst|manager|designer|architect|lead|director|"
    r"researcher|programmer|devops|sre|administrator|consultant|specialist|intern|"
    r"head of|cto|founder|product)\b"
)
SALARY_HINT = r"(?iU)[$€£]|\b\d{2,3}\s?k\b|\b(usd|eur|gbp)\b"
NON_LOCATION = (
    r"(?iU)^(full[- ]?time|part[- ]?time|contract|contractor|internship|visa|relocation|"
    r"equity|hiring|apply)\b"
)

# --- Fixed values: listing selectors (field -> selectors in fallback order) ---
SELECTORS = {
    "card": ["div.card-content", "div.card"],
    "title": ["h2.title", "h2", "h3.title"],
    "company": ["h3.company", "h3.subtitle", "h3"],
    "location": ["p.location", "p.is-6"],
    "posted": ["time"],
    "link": ["footer a.card-footer-item", "a"],
}

# --- Fixed values: salary patterns -------------------------------------------
AMOUNT = r"[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+(?:\.[0-9]+)?"
SALARY_TAIL = r"(?=([\s\S]{0,12}))"
# groups: symbol, low, low k, high, high k, tail
SALARY_SYMBOL_RANGE = (
    rf"(?U)([$€£])\s?({AMOUNT})\s?([kK])?\s*(?:-|–|—|to)\s*(?:[$€£]\s?)?({AMOUNT})\s?([kK])?(?![0-9,])"
    + SALARY_TAIL
)
# groups: low, low k, high, high k, currency code
SALARY_K_RANGE = (
    r"(?iU)([0-9]{2,3})\s?([kK])?\s*(?:-|–|—|to)\s*([0-9]{2,3})\s?([kK])\b\s*(USD|EUR|GBP|CAD|AUD)?"
)
# groups: symbol, amount, k, tail
SALARY_SINGLE = rf"(?U)([$€£])\s?({AMOUNT})\s?([kK])?" + SALARY_TAIL
HOURLY = r"(?iU)^\s*(/|per\s+|an\s+)?\s*(hr|hour|h)\b"
CURRENCY_SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP"}

# --- Fixed values: remote and seniority patterns ------------------------------
REMOTE_POSITIVE = (
    r"(?iU)\b(remote|work(?:ing)? from home|wfh|fully distributed|distributed team|work from anywhere)\b"
)
REMOTE_NEGATIVE = (
    r"(?iU)\b(?:no|not|non|without)[\s-]+(?:fully[\s-]+)?remote\b"
    r"|\bremote\s+(?:is\s+)?not\s+(?:available|possible|an option)\b"
    r"|\bon-?site\s+only\b"
)
SENIORITY_RULES = [
    ("Intern", r"(?iU)\bintern(?:ship)?\b"),
    ("Junior", r"(?iU)\b(?:junior|jr\.?|entry[- ]level|graduate|trainee)\b"),
    ("Manager", r"(?iU)\b(?:manager|director|vp|chief|cto)\b"),
    ("Lead", r"(?iU)\b(?:lead|principal|staff|architect|head of)\b"),
    ("Senior", r"(?iU)\b(?:senior|sr\.?)\b"),
]

# --- Fixed values: dashboards and alerts ---------------------------------------
DEFAULT_SENIORITY = "Not specified"
DEFAULT_COMPANY = "Unknown"
DEFAULT_LOCATION = "Unspecified"
UNKNOWN_CURRENCY = "Unknown"
REMOTE_LABEL = "Remote"
ONSITE_LABEL = "On-site / hybrid"
ALERT_KEYWORDS = ["python", "machine learning", "llm", "remote"]
CSV_COLUMNS = [
    "job_id", "source", "title", "company", "location", "remote", "seniority",
    "salary_min", "salary_max", "salary_currency", "skills", "posted_date",
    "url", "description", "scraped_at",
]

# --- Fixed values: skills ------------------------------------------------------
# Names that are everyday words too: only this spelling or ALL CAPS counts.
CASE_SENSITIVE_NAMES = ["Go", "Swift", "Rust", "Ruby", "Excel", "Spark", "Flask", "Rails"]
NAME_START = r"(?<![A-Za-z0-9_+#.])"
NAME_END = r"(?![A-Za-z0-9_+#]|\.[A-Za-z0-9])"
# skill -> further names, in output order
TAXONOMY = {
    "Python": ["Python3"],
    "JavaScript": ["JS", "ECMAScript"],
    "TypeScript": [],
    "Java": [],
    "C++": [],
    "C#": [],
    "Go": ["Golang"],
    "Rust": [],
    "Kotlin": [],
    "Swift": [],
    "Scala": [],
    "Ruby": [],
    "PHP": [],
    "SQL": [],
    "React": ["React.js", "ReactJS"],
    "Next.js": ["NextJS"],
    "Vue.js": ["Vue", "VueJS"],
    "Angular": ["AngularJS"],
    "Node.js": ["NodeJS"],
    "Django": [],
    "Flask": [],
    "FastAPI": [],
    "Spring Boot": ["SpringBoot"],
    "Ruby on Rails": ["Rails"],
    ".NET": ["dotnet", "ASP.NET"],
    "Laravel": [],
    "jQuery": [],
    "Tailwind CSS": ["Tailwind"],
    "GraphQL": [],
    "REST API": ["RESTful", "REST APIs"],
    "Microservices": [],
    "Pandas": [],
    "NumPy": [],
    "scikit-learn": ["sklearn"],
    "PyTorch": [],
    "TensorFlow": [],
    "Keras": [],
    "Spark": ["PySpark", "Apache Spark"],
    "Hadoop": [],
    "Kafka": ["Apache Kafka"],
    "Airflow": ["Apache Airflow"],
    "dbt": [],
    "Snowflake": [],
    "BigQuery": [],
    "Redshift": [],
    "Databricks": [],
    "Tableau": [],
    "Power BI": ["PowerBI"],
    "Looker": [],
    "Excel": [],
    "PostgreSQL": ["Postgres"],
    "MySQL": [],
    "MongoDB": ["Mongo"],
    "Redis": [],
    "SQLite": [],
    "DynamoDB": [],
    "Cassandra": [],
    "Elasticsearch": ["Elastic Search"],
    "AWS": ["Amazon Web Services"],
    "Azure": [],
    "GCP": ["Google Cloud"],
    "Docker": [],
    "Kubernetes": ["K8s"],
    "Terraform": [],
    "Ansible": [],
    "Jenkins": [],
    "GitHub Actions": [],
    "CI/CD": ["CICD"],
    "Linux": [],
    "Git": [],
    "Prometheus": [],
    "Grafana": [],
    "Machine Learning": ["ML"],
    "Deep Learning": [],
    "NLP": ["Natural Language Processing"],
    "Computer Vision": [],
    "LLM": ["LLMs", "Large Language Models"],
    "LangChain": [],
    "Generative AI": ["GenAI", "Gen AI"],
    "RAG": ["Retrieval-Augmented Generation"],
    "MLOps": [],
    "Hugging Face": ["HuggingFace"],
    "Web Scraping": ["Scrapy", "BeautifulSoup"],
    "Selenium": [],
    "Flutter": [],
    "React Native": [],
    "Android": [],
    "iOS": [],
}
