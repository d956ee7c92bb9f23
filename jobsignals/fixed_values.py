"""Word lists, patterns and limits that decide the results.

Everything here has to keep its exact value for results to stay comparable, so
it is stated once, plainly, and imported wherever it is needed.
"""

# --- skills: canonical name -> spellings that count as a mention -------------
SKILLS = {
    "Python": ["python", "py"],
    "JavaScript": ["javascript", "js", "es6", "node.js", "nodejs", "typescript", "ts"],
    "React": ["react", "reactjs", "react.js"],
    "Vue": ["vue", "vuejs", "vue.js"],
    "Angular": ["angular", "angularjs"],
    "Java": ["java", "jvm"],
    "C++": ["c++", "cpp"],
    "C#": ["c#", "csharp", ".net", "dotnet"],
    "Go": ["golang", "go"],
    "Rust": ["rust"],
    "Ruby": ["ruby", "rails"],
    "PHP": ["php", "laravel"],
    "SQL": ["sql", "mysql", "postgresql", "postgres"],
    "NoSQL": ["nosql", "mongodb", "mongo", "cassandra", "redis"],
    "AWS": ["aws", "amazon web services", "ec2", "lambda", "s3"],
    "GCP": ["gcp", "google cloud"],
    "Azure": ["azure"],
    "Docker": ["docker"],
    "Kubernetes": ["kubernetes", "k8s"],
    "Terraform": ["terraform"],
    "Linux": ["linux", "unix", "ubuntu", "debian", "centos", "redhat"],
    "Git": ["git", "github", "gitlab"],
    "Machine Learning": ["machine learning", "ml", "tensorflow", "pytorch",
                         "scikit-learn", "sklearn", "keras"],
    "Deep Learning": ["deep learning", "dl", "neural network"],
    "Data Science": ["data science", "data scientist", "pandas", "numpy"],
    "Big Data": ["big data", "hadoop", "spark", "kafka"],
    "iOS": ["ios", "swift", "objective-c"],
    "Android": ["android", "kotlin"],
    "Flutter": ["flutter", "dart"],
    "React Native": ["react native"],
}

# --- roles, most specific first: the first class with a hit wins -------------
ROLES = {
    "Data/AI": ["machine learning", "ai", "data scientist", "data engineer",
                "computer vision", "nlp"],
    "DevOps": ["devops", "sre", "site reliability", "kubernetes", "platform engineer",
               "infrastructure"],
    "Mobile": ["ios", "android", "swift", "kotlin", "mobile"],
    "Frontend": ["frontend", "front-end", "react", "vue", "angular", "ui/ux",
                 "web developer"],
    "Backend": ["backend", "back-end", "java", "go", "rust", "api",
                "distributed systems", "scala", "ruby", "php"],
    "Fullstack": ["fullstack", "full-stack"],
}
ROLE_FALLBACK = "General"

# --- boolean signals: flag column -> substrings, in output column order ------
FLAG_GROUPS = {
    "Seniority": {
        "is_senior": ["senior", "lead", "principal", "staff", "architect"],
        "is_junior": ["junior", "entry-level", "entry level", "intern", "associate",
                      "new grad", "fresh grad"],
        "is_manager": ["manager", "director", "vp", "head of", "founder", "chief",
                       "cto", "ceo", "engineering manager"],
    },
    "Location Tiers": {
        "is_tier_1_city": ["san francisco", "sf", "nyc", "new york", "seattle",
                           "bay area", "silicon valley", "london"],
        "is_europe": ["london", "berlin", "paris", "amsterdam", "dublin", "remote eu",
                      "europe"],
        "is_global_remote": ["remote worldwide", "global remote", "anywhere",
                             "remote (global)"],
    },
    "Company Stage": {
        "is_yc": ["yc", "y combinator", "ycombinator"],
        "is_funded": ["series a", "series b", "series c", "raised", "funding", "backed"],
        "is_crypto": ["web3", "crypto", "blockchain", "defi", "ethereum", "solana",
                      "bitcoin", "smart contract"],
    },
    "Compensation": {
        "has_equity": ["equity", "stock options", "rsu", "stock", "ownership", "%"],
        "offers_visa": ["visa", "sponsorship", "h1b", "relocation"],
    },
}
REMOTE_WORD = "remote"
AI_MODEL_WORDS = ["pytorch", "llm", "large language model"]
COMBO_FLAGS = {"Interactions": ["tech_combo_ai", "tech_combo_blockchain"]}

# --- pay ---------------------------------------------------------------------
PAY_AMOUNT = r"\d{2,3}k|\d{5,6}"
PAY_RANGE_AMOUNT = r"\d{2,3}k?|\d{5,6}"
PAY_SYMBOL = r"[\$€£]"
PAY_SYMBOLS = "$€£"
# The three pay patterns in full; the second has two spellings.
PAY_RANGE = r"[\$€£]?(\d{2,3}k?|\d{5,6})\s*-\s*[\$€£]?(\d{2,3}k?|\d{5,6})"
PAY_FROM = r"(?:from|starting at|\+)\s*[\$€£]?(\d{2,3}k|\d{5,6})\+?"
PAY_PLUS = r"[\$€£]?(\d{2,3}k|\d{5,6})\+"
PAY_SINGLE = r"[\$€£](\d{2,3}k|\d{5,6})"
GBP_MARKS = ["£", "gbp"]
EUR_MARKS = ["€", "eur"]
HOURLY_BELOW = 200          # amounts below this are read as an hourly rate
HOURS_PER_YEAR = 2000
THOUSANDS_BELOW = 1000      # "100-140k": the first amount is in thousands

# --- post hygiene ------------------------------------------------------------
MIN_POST_CHARS = 50
QUOTE_MARK = ">"
COMPANY_MAX_CHARS = 50      # exclusive
# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- salary and experience cleaning used by the market reports ---------------
MONTHLY_PAY = (2000, 15000)             # inclusive, turned into a year's pay
MONTHS_PER_YEAR = 12
PLAUSIBLE_PAY = (15000, 500000)         # inclusive
MAX_YEARS = 30
COMPETITORS = ["Python", "JavaScript", "TypeScript", "Rust", "Go", "Java", "C++"]
TOP_TECH = 10
EXCERPT_CHARS = 200

# --- model training ----------------------------------------------------------
TRAINING_CURRENCY = "USD"
TRAINING_PAY = (10000, 500000)          # exclusive
PAY_BAND_WORDS = ["staff", "principal", "architect", "lead", "head", "director",
                  "vp", "founding"]
TOP_TECH_FEATURES = 50
MISSING_YEARS = -1
BOOL_FEATURES = [
    "is_remote", "is_senior", "is_funded", "is_crypto", "is_junior", "is_manager",
    "is_tier_1_city", "is_europe", "is_global_remote", "is_yc", "has_equity",
    "offers_visa", "tech_combo_ai", "tech_combo_blockchain",
]
# Columns that never enter the salary matrix; `month` is the folder of the stored table.
NOT_FEATURES = ("id", "date", "raw_text", "company_name", "role_title", "salary_min",
                "salary_max", "salary_avg", "log_salary", "currency", "tech_stack",
                "job_category", "month")
SALARY_TERMS = 1000
SALARY_TOKEN = r"\b[a-zA-Z][a-zA-Z]+\b"
ROLE_TERMS = 2000
ROLE_TOKEN = r"\b\w\w+\b"
TRAIN_PERCENT = 80
SEED = 42

# --- forum markup and threads ------------------------------------------------
BASE_URL = "https://news.ycombinator.com"
THREAD_TITLE = r"Ask HN: Who is hiring\? \((\w+) (\d{4})\)"
THREADS_FROM = "2020-01-01"
UNKNOWN_USER = "unknown"
