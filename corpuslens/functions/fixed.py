"""Word lists, symbol maps and patterns the operators must agree on."""

# Technical tokens kept through punctuation removal, in matching order.
PROTECTED_TOKENS = {
    "c++": "token_cpp_token",
    "c#": "token_csharp_token",
    ".net": "token_dotnet_token",
    "asp.net": "token_aspdotnet_token",
    "node.js": "token_nodejs_token",
    "vue.js": "token_vuejs_token",
    "react.js": "token_reactjs_token",
    "angular.js": "token_angularjs_token",
    "d3.js": "token_d3js_token",
    "three.js": "token_threejs_token",
    "ci/cd": "token_cicd_token",
    "tcp/ip": "token_tcpip_token",
    "pl/sql": "token_plsql_token",
    "t-sql": "token_tsql_token",
}

# Final spelling of each protected token, in replacement order.
CANONICAL_TOKENS = {
    "token_cpp_token": "cplusplus",
    "token_csharp_token": "csharp",
    "token_dotnet_token": "dotnet",
    "token_aspdotnet_token": "aspdotnet",
    "token_nodejs_token": "nodejs",
    "token_vuejs_token": "vuejs",
    "token_reactjs_token": "reactjs",
    "token_angularjs_token": "angularjs",
    "token_d3js_token": "d3js",
    "token_threejs_token": "threejs",
    "token_cicd_token": "cicd",
    "token_tcpip_token": "tcpip",
    "token_plsql_token": "plsql",
    "token_tsql_token": "tsql",
}

# Stop words of the corpus profile (the longer list).
PROFILE_STOP_WORDS = [
    "and", "the", "to", "of", "in", "for", "a", "with", "on", "as", "an", "at", "by",
    "is", "all", "from", "that", "this", "or", "be", "are", "state", "city", "company",
    "name", "work", "job", "experience", "skills", "summary", "year", "years", "responsible",
    "duties", "including", "new", "etc", "also", "using", "used", "per", "well", "ensure",
    "weburl", "emailaddr", "phonenum", "various", "multiple", "provide", "provided", "daily",
    "team", "time", "high", "ability", "strong", "knowledge", "system", "systems", "day",
]

# The shorter list is the longer one up to "phonenum".
SHORT_STOP_WORDS = PROFILE_STOP_WORDS[: PROFILE_STOP_WORDS.index("phonenum") + 1]

# Dictionary of skills looked up in a document.
SKILLS = [
    # Languages
    "Python", "Java", "C++", "C#", ".NET", "JavaScript", "TypeScript", "Go", "Golang", "Rust",
    "Ruby", "PHP", "Swift", "Kotlin", "R", "MATLAB", "Scala", "SQL", "HTML", "CSS", "Bash", "Shell", "PowerShell",
    # Data & AI
    "Machine Learning", "Deep Learning", "NLP", "Computer Vision", "Data Science", "Data Analysis",
    "Artificial Intelligence", "Neural Networks", "PyTorch", "TensorFlow", "Keras", "Scikit-Learn",
    "Pandas", "NumPy", "SciPy", "OpenCV", "Spark", "PySpark", "Hadoop", "Databricks", "BigQuery",
    "Snowflake", "Airflow", "Tableau", "Power BI", "Excel", "Statistics", "Predictive Modeling",
    # Cloud & DevOps
    "AWS", "Azure", "GCP", "Google Cloud", "Docker", "Kubernetes", "Terraform", "CI/CD", "Jenkins",
    "Git", "GitHub Actions", "GitLab", "Linux", "Nginx", "Ansible", "Microservices", "Prometheus", "Grafana",
    # Web & Backend
    "React", "Next.js", "Node.js", "Express", "Django", "FastAPI", "Flask", "Spring Boot",
    "GraphQL", "REST APIs", "REST API", "WebSockets", "Redis", "PostgreSQL", "MySQL", "MongoDB", "SQLite", "Elasticsearch", "Kafka",
    # Business, Finance & Management
    "Financial Modeling", "DCF", "Valuation", "GAAP", "Accounting", "QuickBooks", "SAP", "Salesforce",
    "CRM", "ERP", "Budgeting", "Forecasting", "Auditing", "Tax Audits", "Equity Research", "Variance Analysis",
    "Risk Management", "Six Sigma", "Agile", "Scrum", "JIRA", "Project Management", "Product Management", "Due Diligence",
    "Talent Acquisition", "Recruiting", "HRIS", "Workday", "Onboarding", "Labor Law Compliance",
    # Healthcare & Clinical
    "Patient Triage", "Medication Administration", "BLS", "ACLS", "CPR", "EMR", "EHR", "Epic", "Cerner",
    "Patient Care", "HIPAA", "Phlebotomy", "Clinical Research", "Wound Care", "Acute Care", "Nursing",
    # Engineering & Design
    "CAD", "AutoCAD", "SolidWorks", "Revit", "Quality Assurance", "QA Testing", "UI/UX", "Figma",
    "Adobe Photoshop", "Illustrator", "InDesign", "Blender",
]

# Generic terms that fill up the evidence list.
EVIDENCE_CANDIDATES = [
    "Algorithms", "Architecture", "Analysis", "Engineering", "Development",
    "Management", "Infrastructure", "Security", "Operations", "Design",
    "System Design", "Database", "Networks", "Framework", "Optimization",
    "Automation", "Clinical", "Valuation", "Compliance", "Recruiting", "Testing",
]

# Messages of the input check.
EMPTY_MESSAGE = "Input text is empty or invalid. Please provide resume text."
SHORT_MESSAGE = "Input text is too short to be a valid resume (fewer than 5 words)."

# Sizes and thresholds.
MIN_WORDS = 10
MIN_SCORING_WORDS = 5
EMBEDDING_PREFIX = 2500
PREVIEW_CHARS = 1200
