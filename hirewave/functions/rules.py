"""Fixed values that must equal the original pipeline's for identical results.

Everything in this module is data: ordered rule lists, word lists and
column lists.  The code that turns them into Spark expressions lives in
``hirewave.functions.exprs``; nothing here depends on Spark.

Rule lists are ordered: the first rule that matches wins.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES — title taxonomy (SQL LIKE patterns on the lower-cased,
# stripped title; first match wins; no match keeps the title).
# --------------------------------------------------------------------------
TITLE_RULES: list[tuple[str, list[str]]] = [
    ("Backend Developer", ["%back%end%", "%backend%"]),
    ("UI/UX Developer", ["%ui%ux%"]),
    ("Business Analyst", ["%business%analyst%"]),
    ("Business Intelligence", ["%business%intelligence%"]),
    ("Data Analyst", ["%data%analyst%"]),
    ("Web Designer", ["%web%designer"]),
    ("Network Engineer", ["%network%engineer"]),
    (".Net Developer", ["%.net%"]),
    ("Machine Learning Engineer", ["%machine learning%"]),
    ("Azure Data Engineer", ["%azure%data engineer%"]),
    ("AWS Data Engineer", ["%aws%data engineer%"]),
    ("Data Engineer", ["%data engineer%"]),
    ("DevOps Engineer", ["%devops%"]),
    ("Application Support", ["%application support%"]),
    ("Quality Assurance", ["%quality%assurance%", "%quality engineer%", "%qa%"]),
    ("React JS Developer", ["%react%js%"]),
    ("Frontend Developer", ["%front%end%"]),
    ("Full Stack Developer", ["%full%stack%"]),
    ("Software Engineer", ["%software%engineer%"]),
    ("Product Manager", ["%product%manager%"]),
    ("System Engineer", ["%system%engineer%"]),
    ("Azure Cloud Engineer", ["%azure%cloud%engineer"]),
    ("Azure Cloud Architect", ["%azure%cloud%architect"]),
    ("Data Scientist", ["%data%scientist%"]),
    ("IT Analyst", ["%it%analyst%"]),
    ("Business Development", ["%business%development%"]),
    ("Blockchain Developer", ["%blockchain%"]),
    ("Java Developer", ["%java%developer%"]),
    ("Data Warehousing", ["%data warehouse%"]),
    ("Support Engineer", ["%support engineer%"]),
    ("Digital Marketing", ["%digital marketing%"]),
    ("Marketing", ["%marketing%"]),
    ("ETL Developer", ["%etl%"]),
    ("Scrum Master", ["%scrum master%"]),
    ("System Administrator", ["%system administrator%"]),
    ("iOS Developer", ["%ios developer%"]),
    ("Graphics Designer", ["%graphics designer%"]),
    ("Professor", ["%professor%"]),
    ("Data Entry", ["%data entry%"]),
    ("Cyber Security", ["%cyber security%"]),
    ("Python Developer", ["%python developer%"]),
    ("Principal Scientist", ["%principal scientist%"]),
    ("PHP Developer", ["%php%developer%"]),
    ("Data Architect", ["%data architect%"]),
    ("Mechanical Engineer", ["%mechanical engineer%"]),
    ("Civil Engineer", ["%civil engineer%"]),
    ("Product Analyst", ["%product analyst%"]),
    ("AI Prompt Engineer", ["%ai prompt engineer%"]),
    ("Nurse", ["%nurse%"]),
    ("AI Engineer", ["%ai engineer%"]),
    ("Angular Developer", ["%angular developer%"]),
    ("Project Manager", ["%project manager%"]),
    ("C++ Developer", ["%c++%"]),
]

# --------------------------------------------------------------------------
# FIXED VALUES — skill taxonomy.  Each pattern is matched with LIKE against
# lower(skill), except patterns flagged case-sensitive (True), which are
# matched against the skill as written.  'aiaS' can never match lower(skill);
# it is kept as a dead rule.
# --------------------------------------------------------------------------
SKILL_RULES: list[tuple[str, list[tuple[str, bool]]]] = [
    ("AI Chatbot Tuning and Training", [("%ai chatbot tuning%", False)]),
    ("2D and 3D vision technology", [("%2d and%", False)]),
    ("A/B Testing", [("ab%test%", False), ("ab%experiment%", False)]),
    ("AIaaS", [("aiaS", False)]),
    ("Arima Modeling", [("%arima%", False)]),
    ("APIs Microservices", [("apismicroservices", False)]),
    ("ARCGIS Notebook", [("%arcgis%", False)]),
    ("AR/VR Systems", [("%arvr%", False)]),
    ("ASR systems", [("asr", False)]),
    ("AWS Sagemaker", [("%sagemaker%", False)]),
    ("AWS Platform", [("%amazon%web service", False)]),
    ("PostgreSQL", [("%postgre%", False)]),
    ("Recommender system", [("%recomnmend%", False)]),
    ("Reinforcement Learning", [("%reinforce%", False)]),
    ("NoSQL Database", [("%no%sql%", False)]),
    ("Deep Neural Network", [("%deep%neural%net%", False)]),
    ("Networking", [("%networking%", False)]),
    ("Statistical Modeling Technique", [("%stat%model%", False)]),
    ("Workflow Orchestration Tool", [("%workflow%", False)]),
    ("Azure Data Factory", [("%azure%data%facto%", False)]),
    ("Adobe Acrobat", [("adobe acrobat%", False)]),
    ("Autocad", [("autocad%", False)]),
    ("Dslr Camera Photography/Videography", [("dsl%", False)]),
    ("Geographic Information System", [("geographic%", False)]),
    ("Google Analytics", [("%google%analytics%", False)]),
    ("Apache Spark", [("%spark%", False)]),
    ("Python", [("%python%", False)]),
    ("MySQL Database", [("%mysql%", False)]),
    ("Apache Airflow", [("%airflow%", False)]),
    ("Agile Software Development", [("%agile%", False)]),
    ("Javascript", [("%java%script%", False)]),
    ("Tensorflow", [("%tensorflow%", False)]),
    ("Java", [("%java%", False)]),
    ("ReactJS", [("%react%", False)]),
    ("AngularJS", [("%angular%", False)]),
    ("Node", [("%node%", False)]),
    ("Tableau", [("%tableau%", False)]),
    ("NextJS", [("%next%js%", False)]),
    ("Docker", [("%docker%", False)]),
    ("Power BI", [("%power%bi%", False)]),
    (".NET", [("net", False)]),
    ("Data Warehousing", [("data warehous%", False)]),
    ("Data Integration", [("data integration", False)]),
    ("Data Modeling", [("data model%", False)]),
    ("API", [("API%", True)]),
    ("Data Cleaning", [("data clean%", False)]),
    ("Linux", [("%linux%", False)]),
    ("scala", [("scala", False)]),
    ("Google cloud platform", [("google cloud%", False)]),
    ("GIT", [("git", False)]),
    (".NET", [("%.net%", False)]),
    ("AWS Services", [("%aws%cloud%", False), ("aws", False), ("%aws%service%", False)]),
    ("AWS Glue", [("%aws%glue%", False)]),
    ("AWS Lambda", [("%lambda%", False)]),
    ("Azure Cloud Services", [("%azure%cloud%", False)]),
    ("Kubernetes", [("%kubernetes%", False)]),
    ("ETL", [("%etl%", False)]),
    ("Integration", [("integration", False)]),
    ("Large Language Model (LLM)", [("%large%language%model%", False), ("llm%", False)]),
]

# --------------------------------------------------------------------------
# FIXED VALUES — industry verticals.  Case-insensitive regex families tested
# in this order; first hit wins; otherwise the literal 'None'.
# --------------------------------------------------------------------------
VERTICAL_RULES: list[tuple[str, str]] = [
    ("PR", "Product|Resources|Energy|Utilities|Logistics|Retail|Consumer|Goods|Travel|Hospitality|Oil|Gas|Transportation|Machinery|Semiconductor|Plastics"),
    ("HC_INCS_LS", "Insurance|Life Science|Healthcare|Hospitals|Pharmaceutical|Biotechnology|Medical"),
    ("CMT", "Communication|Entertainment|Media|Telecommunications|Information|Internet|Software|IT Services|Technology|Computer|Network|Wireless|Hospitals|Health Care"),
    ("BFS_EDU_GOV", "Education|Government|Banking|Financial|Accounting|Book|Publishing|E-Learning|Business|Investment|Capital|Finance"),
]
VERTICAL_DEFAULT = "None"

# --------------------------------------------------------------------------
# FIXED VALUES — title words that drop a posting (case-insensitive substring).
# --------------------------------------------------------------------------
MANAGER_WORDS: list[str] = ["vp", "director", "graphic", "multimedia", "vehicle", "digital", "business", "manager"]

# --------------------------------------------------------------------------
# FIXED VALUES — industry words that drop a company (case-sensitive substring).
# --------------------------------------------------------------------------
INDUSTRY_WORDS: list[str] = [
    "space", "defense", "aviation", "aerospace", "government", "human resources", "non-profit", "robotics",
    "public relation", "political", "chemical", "chemistry", "outsourcing", "offshoring",
]

# --------------------------------------------------------------------------
# FIXED VALUES — title clean-up regexes, applied in order to the lower-cased
# title, each replaced by ''.  Leftover blanks are not collapsed.
# --------------------------------------------------------------------------
TITLE_STRIP_PATTERNS: list[str] = [
    r"\((\$[\d, ]+.*?)\)|\$\d+(,\d+)*",
    r"\|*remote\|*",
    r"\|*hybrid\|*",
    r"\|*\(\)\|*",
]

# --------------------------------------------------------------------------
# FIXED VALUES — search keyword -> main title (ordered; case-insensitive
# exact match; first list that holds the keyword wins; else the keyword).
# Deviation: the original list glues "Ruby" and "Node.js" into one keyword
# through a missing comma; here they are two keywords.
# --------------------------------------------------------------------------
TITLE_MAPPING: list[tuple[str, list[str]]] = [
    ("Data Engineer", ["Data Engineer Aws", "Data Engineer Azure", "Data Engineer Snowflake", "Data Engineer Databricks", "Data Engineer GCP",
                       "DataOPS AWS", "DataOPS Azure", "DataOPS Snowflake", "DataOPS Databricks", "DataOPS GCP",
                       "Data Annotator", "Data Governance", "Data Quality"]),
    ("Data Analyst", ["Data Analyst PowerBI", "Data Analyst Tableau", "Data Analyst Looker", "Data Analytics Solution Architech"]),
    ("Machine Learning Engineer", ["Machine Learning Engineer", "Computer Vision Enginer", "Natural Language Engineer", "Data Scientist"]),
    ("AI", ["AI Engineer", "AI Researcher", "MLOps", "Generative AI"]),
    ("FrontEnd", ["React.js", "Angular.js", "Vue.js", "Next.js", "Nuxt.js", "Svelte", "Solid.js", "Astro", "Qwik"]),
    ("BackEnd", ["PHP", "Laravel", "Go", "Python Backend", "Django", "Flask", "Java", "Spring", "Ruby", "Node.js", "Nest.js", "Elixir"]),
    ("Mobile", ["React Native", "Flutter", "Xamarin", "Ionic", "Android", "Kotlin", "Objective-C", "Swift"]),
    ("UI/UX", ["Balsamiq", "Figma", "Adobe XD", "Adobe Illustrator", "Miro", "UI/UX"]),
    ("FrontEnd Development", ["HTML/CSS", "Bootstrap", "Tailwind", "Foundation", "Bulma"]),
    ("QC", ["Test Planning and Management", "Test Automation", "API Testing", "Performance Testing", "Cypress", "Selenium", "TestRail", "SonarQube"]),
    ("Project Management", ["Project Management"]),
    ("DevOps", ["DevOps AWS", "DevOps Azure", "DevOps Google Cloud", "DevOps Docker", "DevOps Kubernetes", "DevOps Terraform", "DevOps CI/CD"]),
]

# --------------------------------------------------------------------------
# FIXED VALUES — main title -> department (case-insensitive; else NULL).
# --------------------------------------------------------------------------
DEPARTMENT_MAPPING: list[tuple[str, list[str]]] = [
    ("Data Engineering", ["Data Engineer", "Data Analyst"]),
    ("Service Engineering", ["FrontEnd", "BackEnd", "Full Stack", "Mobile"]),
    ("DevOps", ["DevOps"]),
    ("AI Services", ["Machine Learning Engineer", "AI"]),
    ("Design", ["UI/UX", "FrontEnd Development"]),
    ("PMO", ["Project Management"]),
    ("QC", ["QC"]),
]

# --------------------------------------------------------------------------
# FIXED VALUES — search facets and paging.
# --------------------------------------------------------------------------
RESULT_CAP = 1000          # results one search can page through
PAGE_SIZE_A = 25           # postings per page, board A
PAGE_SIZE_B = 20           # postings per page, board B
SEARCH_LOCATION = "United States"
RECENCY_PARAM = "r86400"   # last 24 hours, in seconds
RECENCY_SECONDS = 86400

# --------------------------------------------------------------------------
# FIXED VALUES — column lists of the cleaning job.
# --------------------------------------------------------------------------
TRIM_COLUMNS: list[str] = ["extract_date", "department", "domains", "search_title", "title", "company",
                           "salary", "location", "job_type", "posted_on", "job_url", "description"]
DEDUP_KEYS: list[str] = ["company", "department", "domains", "title", "extract_date", "location",
                         "job_type", "description", "ORG", "ROLE", "DOMAIN"]
ARRAY_SIBLING_COLUMNS: list[str] = ["DATE", "DEG", "DOMAIN", "EMAIL", "EXP", "LOC", "ORG", "PER", "PHONE",
                                    "PROJECT", "ROLE", "soft_skills", "UNI"]
# producer spellings of the two skill columns
SKILL_COLUMN_ALIASES: list[tuple[str, str, str]] = [
    ("HARD SKILLS", "SOFT SKILLS", "first producer"),
    ("HARD_SKILLS#0", "SOFT_SKILLS#1", "second producer"),
]
# columns of a validation row: rows scraped, rows left, companies, companies left
COUNT_COLUMNS: list[str] = ["initial_scrapped_data_count", "scrapped_data_count_after_removing_managerial_post",
                            "total_number_of_companies", "number_of_company_after_company_industry_filtered"]
COMPANY_DROP_COLUMNS: list[str] = ["year", "month", "day", "company_url"]
PARTITION_COLUMNS: list[str] = ["year", "month", "day"]

# final column order of the unexploded silver table (verticals is appended)
SILVER_COLUMNS: list[str] = [
    "extract_date", "department", "domains", "search_title", "title_cleaned", "title", "company", "salary",
    "location", "seniority_level", "job_type", "industries", "job_function", "posted_on", "job_url",
    "DATE", "DEG", "DOMAIN", "hard_skills", "EMAIL", "EXP", "LOC", "ORG", "PER", "PHONE", "PROJECT", "ROLE",
    "soft_skills", "UNI", "state", "place", "company_url", "company_name", "website", "company_industry",
    "company_size", "headquarters", "type", "founded", "specialties", "year", "month", "day",
]

# board B field map onto the board A schema
LINK_COLUMNS = ["extract_date", "department", "main_title", "job_title", "url"]
BOARD_B_COLUMNS = ["search_keyword_for_job", "job_title", "job_url", "company", "location", "job_type", "salary",
                   "posted_on", "job_qualification", "job_description"]
BOARD_B_LISTS = ["job_qualification", "job_description"]
BOARD_B_RENAMES: dict[str, str] = {
    "job_title": "title",
    "search_keyword_for_job": "search_title",
    "job_description": "description",
}

# source tables of the silver job, sorted
SOURCE_TABLES: list[str] = ["board_a", "board_b"]

# --------------------------------------------------------------------------
# FIXED VALUES — detail-page markers of board B (data-testid attributes).
# --------------------------------------------------------------------------
DETAIL_SPANS: list[tuple[str, str]] = [
    ("company", "viewJobCompanyName"),
    ("location", "viewJobCompanyLocation"),
    ("job_type", "viewJobBodyJobDetailsJobType"),
    ("salary", "viewJobBodyJobCompensation"),
    ("posted_on", "viewJobBodyJobPostingTimestamp"),
]
QUALIFICATIONS_TESTID = "viewJobQualificationsContainer"
DESCRIPTION_TESTID = "viewJobBodyJobFullDescriptionContent"
PAGER_LINK_CLASS = "chakra-link css-1wxsdwr"
RESULT_LABEL_CLASS = "results-context-header__new-jobs"
JOB_LIST_ID = "job-list"
JOB_ITEM_CLASS = "css-0"

# --------------------------------------------------------------------------
# FIXED VALUES — printed skill lists and location text.
# --------------------------------------------------------------------------
SKILL_LIST_EDGES = r"(^\[')|(\']$)"   # stripped from both printed forms
SKILL_COMMA_SEP = "', '"              # item separator, comma form (deduped)
SKILL_SPACE_SEP = "' '"               # item separator, space form; also the form marker
SKILL_SPACE_DROP = "\n"               # removed from the space form before splitting
LOCATION_SEP = ", "                   # 'place, state'
LOCATION_PLACE_JOIN = ","             # place when the location has not exactly two parts
LOCATION_JOIN = "-"                   # location parts re-joined

# --------------------------------------------------------------------------
# FIXED VALUES — search and list-page markup of the boards.
# --------------------------------------------------------------------------
SEARCH_PARAMS = ("keywords", "location", "f_TPR", "f_E", "f_WT", "start")   # in request order
DETAIL_LINK_JOIN = "&job="            # list-page url + this + job key
PAGER_LABEL = "page "                 # aria-label of the pager link to page n
