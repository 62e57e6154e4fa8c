"""Fixed values of the job-posting preset: word lists, patterns and tables, as the data define them."""

# Skill keywords.
SKILLS = [
    "python", "sql", "java", "scala", "c++", "c#", "javascript", "typescript",
    "bash", "shell", "powershell", "rust", "go", "ruby", "php", "r", "excel",
    "git", "linux",
    "postgresql", "mysql", "oracle", "sql server", "mongodb", "redis", "elasticsearch",
    "cassandra", "dynamodb", "neo4j", "hbase", "couchbase", "mariadb", "sqlite",
    "memcached",
    "aws", "azure", "gcp", "google cloud", "amazon web services",
    "ec2", "s3", "lambda", "glue", "redshift", "athena", "kinesis", "emr", "rds",
    "bigquery", "dataproc", "dataflow", "pub/sub", "cloud storage",
    "cloudformation",
    "hadoop", "spark", "kafka", "flink", "storm", "hive", "pig", "sqoop", "hbase",
    "zookeeper", "hdfs", "yarn", "mapreduce", "presto", "trino", "kinesis",
    "airflow", "nifi", "talend", "informatica", "datastage", "pentaho",
    "ssis", "ssas", "dbt", "dagster", "prefect", "airbyte",
    "power bi", "tableau", "qlik", "looker", "metabase", "superset", "cognos",
    "microstrategy", "sisense", "thoughtspot",
    "docker", "kubernetes", "k8s", "terraform", "ansible", "jenkins", "gitlab ci",
    "github actions", "ci/cd", "helm", "istio", "prometheus", "grafana",
    "logstash", "kibana",
    "machine learning", "ml", "deep learning", "artificial intelligence",
    "nlp", "computer vision", "predictive modeling", "statistics", "linear regression",
    "logistic regression", "decision tree", "random forest", "xgboost", "tensorflow",
    "pytorch", "scikit-learn", "pandas", "numpy", "matplotlib", "seaborn",
    "datahub", "openmetadata",
    "api", "rest api", "graphql", "microservices", "event-driven", "message queue",
    "rabbitmq", "activemq", "pub/sub", "streaming", "batch processing",
    "real-time", "near real-time",
    "sap", "sap bw",
]

# Domain keywords.
DOMAINS = [
    "data warehouse", "data lakehouse", "data mesh", "data fabric", "data federation",
    "data governance", "data quality", "data lineage", "metadata management", "data catalog",
    "data observability", "data profiling", "data validation", "master data management", "mdm",
    "batch processing", "real-time", "near real-time", "lambda architecture", "kappa architecture",
    "fintech", "loyalty", "ecommerce", "banking", "airline", "logistics", "genai", "llm",
    "machine learning", "ai",
]

# Roles by pattern on the lower-cased title, first match wins.
ROLES = [
    (r"\bdata engineer\b", "Data Engineer"),
    (r"\bdata analyst\b", "Data Analyst"),
    (r"\bdata scientist\b", "Data Scientist"),
    (r"\bbusiness intelligence\b|\bbi\b", "BI Analyst"),
    (r"\bmachine learning\b|\bml\b", "ML Engineer"),
    (r"\bai engineer\b|\bartificial intelligence\b", "AI Engineer"),
    (r"\bdata\s*&\s*reporting\b", "Data Manager"),
    (r"\bdata\s*manager\b", "Data Manager"),
    (r"\breporting\s*manager\b", "Reporting Manager"),
    (r"\bdata quality\b", "Data Quality Engineer"),
    (r"\bdata\s*quality\s*engineer\b", "Data Quality Engineer"),
    (r"\bdata\s*solution\s*consultant\b", "Data Consultant"),
    (r"\bdata\s*consultant\b", "Data Consultant"),
    (r"\bdata\s*solution\s*architect\b", "Data Architect"),
    (r"\bdatabase\s*engineering\b", "Database Engineer"),
    (r"\bdatabase\s*administrator\b|\bdba\b", "Database Engineer"),
    (r"\bdata platform\b", "Data Platform Engineer"),
    (r"\bdata\s*platform\s*engineer\b", "Data Platform Engineer"),
    (r"\betl developer\b", "ETL Developer"),
    (r"\bdata\s*ops\b", "DataOps Engineer"),
    (r"\banalytics engineer\b", "Analytics Engineer"),
    (r"\bdata\s*analytics\s*engineer\b", "Analytics Engineer"),
]

# City by substring of the lower-cased location, first match wins.
CITIES = {
    "Hà Nội": ["hà nội (mới)", "ha noi (new)", "hanoi (new)", "hà nội", "ha noi", "hanoi", "hn", "thủ đô"],
    "Hồ Chí Minh": [
        "hồ chí minh (mới)", "ho chi minh (new)", "thành phố hồ chí minh", "tp.hồ chí minh", "tp hồ chí minh",
        "hồ chí minh", "ho chi minh", "tp.hcm", "tp hcm", "hcm", "sài gòn", "saigon",
    ],
    "Đà Nẵng": ["đà nẵng (mới)", "da nang (new)", "đà nẵng", "da nang", "danang"],
    "Hải Phòng": ["hải phòng (mới)", "hai phong (new)", "hải phòng", "hai phong", "haiphong", "hp"],
    "Cần Thơ": ["cần thơ (mới)", "can tho (new)", "cần thơ", "can tho", "cantho", "ct"],
    "Bình Dương": ["bình dương (mới)", "binh duong (new)", "bình dương", "binh duong"],
    "Đồng Nai": ["đồng nai (mới)", "dong nai (new)", "đồng nai", "dong nai"],
    "Bà Rịa - Vũng Tàu": ["bà rịa - vũng tàu", "ba ria - vung tau", "vũng tàu", "vung tau"],
    "Quảng Ninh": ["quảng ninh", "quang ninh"],
    "Khánh Hòa": ["khánh hòa", "khanh hoa"],
    "Hưng Yên": ["hưng yên", "hung yen"],
    "Bắc Ninh": ["bắc ninh", "bac ninh"],
    "Vĩnh Phúc": ["vĩnh phúc", "vinh phuc"],
    "Hải Dương": ["hải dương", "hai duong"],
    "Thái Nguyên": ["thái nguyên", "thai nguyen"],
    "Phú Thọ": ["phú thọ", "phu tho"],
    "Nghệ An": ["nghệ an", "nghe an"],
    "Thanh Hóa": ["thanh hóa", "thanh hoa"],
}

# Seniority by pattern on the lower-cased title, first match wins; then by years.
SENIORITY = [
    (r"\bsenior\b", "Senior"),
    (r"\blead\b", "Lead"),
    (r"\bprincipal\b", "Principal"),
    (r"\bstaff\b", "Staff"),
    (r"\bjunior\b", "Junior"),
    (r"\bmiddle\b", "Middle"),
    (r"\bfresher\b", "Fresher"),
    (r"\bintern\b", "Intern"),
]
YEARS = [(0, 1, "Junior"), (2, 3, "Middle"), (4, 6, "Senior"), (7, 100, "Lead")]

# Work mode by substring, first match wins; (mode, work from home).
WORK_MODES = [
    ("remote", "Remote", True),
    ("work from home", "Remote", True),
    ("wfh", "Remote", True),
    ("hybrid", "Hybrid", True),
    ("onsite", "Onsite", False),
    ("on-site", "Onsite", False),
    ("tại văn phòng", "Onsite", False),
]

# Schedule types.
SCHEDULES = {
    "Toàn thời gian": "Full-time",
    "Full-time": "Full-time",
    "Bán thời gian": "Part-time",
    "Part-time": "Part-time",
    "Thực tập": "Internship",
    "Internship": "Internship",
}

# Words of which a role's titles hold at least one.
ROLE_WORDS = {
    "Data Engineer": ["data", "engineer"],
    "Data Analyst": ["data", "analyst"],
    "Data Scientist": ["data", "scientist"],
    "BI Analyst": ["bi", "business intelligence", "analyst"],
    "ML Engineer": ["machine learning", "ml", "engineer"],
    "AI Engineer": ["ai", "artificial intelligence", "engineer"],
    "Database Engineer": ["database", "db", "engineer"],
    "Data Architect": ["data", "architect"],
    "Data Platform Engineer": ["data", "platform", "engineer"],
    "ETL Developer": ["etl", "developer"],
    "DataOps Engineer": ["dataops", "data ops", "engineer"],
    "Analytics Engineer": ["analytics", "engineer"],
}
