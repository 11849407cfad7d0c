"""Ordered keyword rules and lookup tables.

FIXED VALUES. Everything in this module must equal the source system's
dictionaries for results to agree: labels, keywords, their order (order is
priority: the first group whose keyword occurs wins), province merge keys,
coordinates and band edges. They are stated plainly, in their natural order.
A rule set is a tuple of ``(label, (keyword, ...))``.

The one deliberate change: the v2 hard-skill keyword for C++ is the literal
text ``c++`` (the source escaped an already escaped pattern, so it could
never match).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES -- v2 (current pipeline)
# ---------------------------------------------------------------------------

JOB_ROLE_V2 = (
    ("Back-end Developer", ("back-end", "backend", "java developer", "python developer", "php developer", "node")),
    ("Front-end Developer", ("front-end", "frontend", "reactjs", "angular", "vuejs", "javascript developer")),
    ("Full-stack Developer", ("full-stack", "fullstack")),
    ("Mobile Developer", ("mobile developer", "ios", "android", "flutter", "react native")),
    ("Game Developer", ("game developer", "unity", "cocos", "unreal")),
    ("Embedded Engineer", ("embedded", "nhúng", "firmware")),
    ("Product Owner/Product Manager", ("product owner", "po", "product manager", "pm ")),
    ("Business Analyst", ("business analyst", "ba ", "phân tích nghiệp vụ")),
    ("Project Leader/Project Manager", ("project leader", "project manager", "quản trị dự án")),
    ("IT Manager", ("it manager", "trưởng phòng it")),
    ("Tech Lead", ("tech lead", "technical lead")),
    ("IT Consultant", ("it consultant", "tư vấn it")),
    ("Designer", ("designer", "thiết kế", "ui/ux", "figma")),
    ("Tester", ("tester", "kiểm thử")),
    ("QA - QC", ("qa", "qc", "quality assurance")),
    ("System Engineer/System Admin", ("system engineer", "system admin", "sysadmin", "quản trị hệ thống")),
    ("DevOps Engineer", ("devops", "devsecops", "sre")),
    ("Cloud Engineer", ("cloud engineer", "aws", "azure", "gcp")),
    ("Data Engineer", ("data engineer", "kỹ sư dữ liệu")),
    ("Data Analyst/Data Scientist", ("data analyst", "data scientist", "bi analyst", "phân tích dữ liệu")),
    ("Database Engineer", ("database engineer", "dba", "quản trị cơ sở dữ liệu")),
    ("AI Engineer/Blockchain Engineer", ("ai engineer", "machine learning", "blockchain", "trí tuệ nhân tạo")),
    ("ERP Engineer/ERP Consultant", ("erp", "sap", "odoo")),
    ("Solution Architect", ("solution architect", "kiến trúc giải pháp")),
    ("IT Support/Helpdesk", ("it support", "helpdesk", "hỗ trợ kỹ thuật")),
)

# keyword found in a location part -> merged province (v2: 81 entries)
PROVINCE_MERGE_V2 = (
    ("kiên giang", "An Giang"), ("an giang", "An Giang"),
    ("bạc liêu", "Cà Mau"), ("cà mau", "Cà Mau"),
    ("bình phước", "Đồng Nai"), ("đồng nai", "Đồng Nai"),
    ("tiền giang", "Đồng Tháp"), ("đồng tháp", "Đồng Tháp"),
    ("long an", "Tây Ninh"), ("tây ninh", "Tây Ninh"),
    ("bến tre", "Vĩnh Long"), ("trà vinh", "Vĩnh Long"), ("vĩnh long", "Vĩnh Long"),
    ("sóc trăng", "TP. Cần Thơ"), ("hậu giang", "TP. Cần Thơ"), ("cần thơ", "TP. Cần Thơ"),
    ("tp. cần thơ", "TP. Cần Thơ"),
    ("phú yên", "Đắk Lắk"), ("đắk lắk", "Đắk Lắk"), ("dak lak", "Đắk Lắk"),
    ("bình định", "Gia Lai"), ("gia lai", "Gia Lai"),
    ("ninh thuận", "Khánh Hoà"), ("khánh hoà", "Khánh Hoà"), ("nha trang", "Khánh Hoà"),
    ("đắk nông", "Lâm Đồng"), ("dak nong", "Lâm Đồng"), ("bình thuận", "Lâm Đồng"), ("lâm đồng", "Lâm Đồng"),
    ("đà lạt", "Lâm Đồng"),
    ("kon tum", "Quảng Ngãi"), ("quảng ngãi", "Quảng Ngãi"),
    ("quảng bình", "Quảng Trị"), ("quảng trị", "Quảng Trị"),
    ("quảng nam", "TP. Đà Nẵng"), ("đà nẵng", "TP. Đà Nẵng"), ("tp. đà nẵng", "TP. Đà Nẵng"),
    ("thừa thiên huế", "TP. Huế"), ("huế", "TP. Huế"), ("tp. huế", "TP. Huế"),
    ("bắc giang", "Bắc Ninh"), ("bắc ninh", "Bắc Ninh"),
    ("thái bình", "Hưng Yên"), ("hưng yên", "Hưng Yên"),
    ("yên bái", "Lào Cai"), ("lào cai", "Lào Cai"),
    ("hà nam", "Ninh Bình"), ("nam định", "Ninh Bình"), ("ninh bình", "Ninh Bình"),
    ("hòa bình", "Phú Thọ"), ("vĩnh phúc", "Phú Thọ"), ("phú thọ", "Phú Thọ"),
    ("bắc kạn", "Thái Nguyên"), ("bắc cạn", "Thái Nguyên"), ("thái nguyên", "Thái Nguyên"),
    ("hà giang", "Tuyên Quang"), ("tuyên quang", "Tuyên Quang"),
    ("hải dương", "TP. Hải Phòng"), ("hải phòng", "TP. Hải Phòng"), ("tp. hải phòng", "TP. Hải Phòng"),
    ("hà nội", "TP. Hà Nội"), ("hn", "TP. Hà Nội"), ("tp. hà nội", "TP. Hà Nội"),
    ("bình dương", "TP. Hồ Chí Minh"), ("bà rịa", "TP. Hồ Chí Minh"), ("vũng tàu", "TP. Hồ Chí Minh"),
    ("bà rịa - vũng tàu", "TP. Hồ Chí Minh"), ("hồ chí minh", "TP. Hồ Chí Minh"), ("hcm", "TP. Hồ Chí Minh"),
    ("tphcm", "TP. Hồ Chí Minh"), ("sg", "TP. Hồ Chí Minh"), ("tp. hồ chí minh", "TP. Hồ Chí Minh"),
    ("cao bằng", "Cao Bằng"), ("điện biên", "Điện Biên"), ("hà tĩnh", "Hà Tĩnh"),
    ("lai châu", "Lai Châu"), ("lạng sơn", "Lạng Sơn"), ("nghệ an", "Nghệ An"),
    ("quảng ninh", "Quảng Ninh"), ("sơn la", "Sơn La"), ("thanh hóa", "Thanh Hóa"),
)

# merged province -> (region, latitude, longitude) (v2: 35 entries)
PROVINCE_COORD_V2 = (
    ("TP. Hà Nội", "Bắc", 21.0285, 105.8542),
    ("Bắc Ninh", "Bắc", 21.1861, 106.0763),
    ("Hưng Yên", "Bắc", 20.9333, 106.3167),
    ("TP. Hải Phòng", "Bắc", 20.8449, 106.6881),
    ("Phú Thọ", "Bắc", 21.3228, 105.2539),
    ("Thái Nguyên", "Bắc", 21.5672, 105.8244),
    ("Ninh Bình", "Bắc", 20.2541, 105.9751),
    ("Quảng Ninh", "Bắc", 20.9500, 107.0833),
    ("Lào Cai", "Bắc", 22.4856, 103.9707),
    ("Tuyên Quang", "Bắc", 21.8251, 105.2114),
    ("Cao Bằng", "Bắc", 22.6567, 106.2526),
    ("Lạng Sơn", "Bắc", 21.8333, 106.7333),
    ("Sơn La", "Bắc", 21.3265, 103.9048),
    ("Điện Biên", "Bắc", 21.3916, 103.0189),
    ("Lai Châu", "Bắc", 22.3929, 103.4735),
    ("TP. Đà Nẵng", "Trung", 16.0544, 108.2022),
    ("Nghệ An", "Trung", 18.6734, 105.6791),
    ("Thanh Hóa", "Trung", 19.8077, 105.7765),
    ("Hà Tĩnh", "Trung", 18.3427, 105.9058),
    ("TP. Huế", "Trung", 16.4637, 107.5909),
    ("Quảng Trị", "Trung", 16.7686, 107.1822),
    ("Quảng Ngãi", "Trung", 15.1205, 108.7923),
    ("Khánh Hoà", "Trung", 12.2388, 109.1967),
    ("Gia Lai", "Trung", 13.9833, 108.0000),
    ("Lâm Đồng", "Trung", 11.9404, 108.4583),
    ("Đắk Lắk", "Trung", 12.6667, 108.0500),
    ("TP. Hồ Chí Minh", "Nam", 10.8231, 106.6297),
    ("Đồng Nai", "Nam", 10.9574, 106.8427),
    ("Tây Ninh", "Nam", 11.3667, 106.1167),
    ("TP. Cần Thơ", "Nam", 10.0452, 105.7469),
    ("Vĩnh Long", "Nam", 10.2541, 105.9723),
    ("An Giang", "Nam", 10.3717, 105.4323),
    ("Cà Mau", "Nam", 9.1769, 105.1524),
    ("Đồng Tháp", "Nam", 10.5333, 105.6833),
    ("Khác", "Khác", 16.0, 112.0),
)

SKILLS_V2 = {
    "hard": (
        ("Python", ("python",)),
        ("Java", ("java ", "java,")),
        ("Go/Golang", ("golang", "go lang")),
        ("JavaScript", ("javascript", "js ", "js,", "js.")),
        ("TypeScript", ("typescript", "ts")),
        ("C++", ("c++",)),
        ("C#", ("c#", ".net", "dotnet")),
        ("PHP", ("php",)),
        ("Ruby", ("ruby", "rails")),
        ("Swift", ("swift",)),
        ("Kotlin", ("kotlin",)),
        ("Dart", ("dart", "flutter")),
        ("R", ("r lang", "r programming")),
        ("SQL", ("sql", "mysql", "postgres", "sql server", "nosql", "mongodb", "redis")),
        ("HTML/CSS", ("html", "css")),
        ("Rust", ("rust",)),
        ("Scala", ("scala",)),
        ("Bash/Shell", ("bash", "shell script", "linux")),
        ("PowerShell", ("powershell",)),
        ("VBA", ("vba", "excel macro")),
        ("MATLAB", ("matlab",)),
        ("React", ("react", "reactjs", "react.js", "react native")),
        ("Angular", ("angular",)),
        ("Vue", ("vue", "vuejs")),
        ("NodeJS", ("node", "nodejs", "node.js")),
        ("Spring", ("spring boot", "spring mvc")),
        ("Django/Flask", ("django", "flask")),
        ("AWS", ("aws", "amazon web services")),
        ("Azure", ("azure",)),
        ("GCP", ("gcp", "google cloud")),
        ("Docker", ("docker",)),
        ("Kubernetes", ("k8s", "kubernetes")),
        ("Git", ("git", "github", "gitlab", "svn")),
        ("CI/CD", ("ci/cd", "jenkins", "gitlab ci")),
        ("Excel", ("excel", "spreadsheet", "vlookup", "pivot table")),
        ("Power BI", ("power bi", "powerbi", "dax")),
        ("Tableau", ("tableau",)),
        ("Spark", ("spark", "pyspark")),
        ("Hadoop", ("hadoop", "hive")),
        ("Jira", ("jira", "confluence")),
        ("Figma/Design", ("figma", "photoshop", "adobe xd", "sketch")),
    ),
    "soft": (
        ("Giao tiếp", ("giao tiếp", "communication", "trình bày", "thuyết trình")),
        ("Lãnh đạo/Quản lý", ("lãnh đạo", "leadership", "dẫn dắt", "quản lý nhóm", "team lead", "thúc đẩy")),
        ("Thương lượng", ("thương lượng", "đàm phán", "negotiation")),
        ("Giải quyết vấn đề", ("giải quyết vấn đề", "problem solving", "xử lý tình huống")),
        ("Tư duy phản biện", ("phản biện", "critical thinking", "tư duy logic", "tư duy hệ thống")),
        ("Sáng tạo", ("sáng tạo", "creative", "innovation", "ý tưởng mới")),
        ("Phân tích", ("kỹ năng phân tích", "analytical")),
        ("Quản lý thời gian", ("quản lý thời gian", "time management", "đúng hạn", "deadline")),
        ("Làm việc nhóm", ("làm việc nhóm", "teamwork", "team work", "hòa đồng", "phối hợp")),
        ("Chịu áp lực", ("chịu được áp lực", "work under pressure", "áp lực cao")),
        ("Tự học/Chủ động", ("tự học", "self-learning", "thích nghi", "ham học hỏi", "chủ động", "cầu tiến")),
        ("Chi tiết/Cẩn thận", ("tỉ mỉ", "cẩn thận", "chi tiết", "detail-oriented")),
    ),
    "language": (
        ("Tiếng Anh", ("tiếng anh", "english", "toeic", "ielts", "toefl", "đọc hiểu tài liệu")),
        ("Tiếng Nhật", ("tiếng nhật", "japanese", "n1", "n2", "n3")),
        ("Tiếng Trung", ("tiếng trung", "chinese", "hsk", "hoa ngữ")),
        ("Tiếng Hàn", ("tiếng hàn", "korean", "topik")),
    ),
}

EDUCATION_V2 = (
    ("Tiến sĩ", ("tiến sĩ", "doctorate", "phd")),
    ("Thạc sĩ", ("thạc sĩ", "master", "mba")),
    ("Đại học", ("đại học", "cử nhân", "kỹ sư", "bachelor", "university")),
    ("Cao đẳng", ("cao đẳng", "college")),
    ("Trung cấp", ("trung cấp", "intermediate")),
    ("Tốt nghiệp phổ thông", ("tốt nghiệp thpt", "cấp 3", "12/12")),
    ("Chứng chỉ", (
        "ceh", "ecsa", "iso 27001", "ccna security", "ccnp security", "comptia security", "comptia network+",
        "ccna", "ccnp enterprise", "ccie", "oscp", "cissp", "cisa", "gcih", "comptia security+", "cysa+",
        "pentest+", "aws certified solutions architect", "azure administrator az-104", "google cloud engineer",
        "aws cloud practitioner", "azure fundamentals az-900", "rhcsa", "linux+", "lpi linux essentials",
        "google data analytics", "tableau desktop specialist", "itil 4 foundation", "pmp", "cka (kubernetes)",
        "docker certified associate", "devops engineer",
    )),
)

INDUSTRY_MACRO_V2 = (
    ("Tài chính - Ngân hàng", ("ngân hàng", "chứng khoán", "tài chính", "đầu tư", "bảo hiểm", "kế toán", "kiểm toán", "thuế")),
    ("Sản xuất & Kỹ thuật", (
        "sản xuất", "vận hành sản xuất", "cơ khí", "ô tô", "tự động hóa", "điện / điện tử", "điện lạnh",
        "điện công nghiệp", "bảo trì", "sửa chữa", "dệt may", "da giày", "thời trang", "gỗ", "nội thất", "dầu khí",
        "khoáng sản", "năng lượng", "hóa học", "công nghiệp", "nông nghiệp", "nông lâm ngư nghiệp",
        "kỹ thuật ứng dụng", "quản lý chất lượng", "qa/qc")),
    ("Y tế & Sức khỏe", ("y tế", "dược", "bệnh viện", "chăm sóc sức khỏe", "thẩm mỹ", "làm đẹp", "công nghệ sinh học", "hóa mỹ phẩm", "nha khoa")),
    ("Xây dựng & Bất động sản", ("xây dựng", "bất động sản", "kiến trúc", "thiết kế nội thất", "vật liệu xây dựng")),
    ("Thương mại & Bán lẻ", (
        "bán lẻ", "bán sỉ", "hàng tiêu dùng", "fmcg", "thực phẩm", "đồ uống", "hàng gia dụng", "chăm sóc cá nhân",
        "thương mại tổng hợp", "siêu thị", "thương mại điện tử", "e-commerce")),
    ("Vận tải & Logistics", ("vận chuyển", "giao nhận", "kho vận", "logistics", "kho bãi", "hàng không", "xuất nhập khẩu", "thu mua", "vật tư", "chuỗi cung ứng")),
    ("Dịch vụ & Giải trí", ("du lịch", "nhà hàng", "khách sạn", "nghệ thuật", "thiết kế", "giải trí", "truyền hình", "báo chí", "biên tập", "xuất bản", "in ấn", "tổ chức sự kiện")),
    ("Giáo dục & Đào tạo", ("giáo dục", "đào tạo", "thư viện", "trường học", "trung tâm anh ngữ")),
    ("Marketing & Truyền thông", ("marketing", "tiếp thị", "quảng cáo", "truyền thông", "đối ngoại", "pr", "agency", "digital marketing")),
    ("Dịch vụ doanh nghiệp", ("nhân sự", "hành chính", "thư ký", "luật", "pháp lý", "biên phiên dịch", "thông dịch", "tư vấn", "dịch vụ khách hàng")),
    ("Công nghệ & Viễn thông", ("cntt", "phần mềm", "phần cứng", "mạng", "viễn thông", "bưu chính viễn thông", "internet", "online", "game", "it - phần mềm", "it - phần cứng")),
    ("Kinh doanh / Sales", ("bán hàng", "kinh doanh", "sales", "phát triển thị trường")),
)

INDUSTRY_SUB_V2 = (
    ("Software Development", (
        "front-end", "frontend", "back-end", "backend", "fullstack", "full-stack", "software developer",
        "software engineer", "lập trình viên", "coder", "developer", "embedded", "nhúng", "firmware")),
    ("Product Management", ("product owner", "product manager", "po", "business analyst", "ba ", "phân tích nghiệp vụ")),
    ("Management & Consulting", ("project leader", "project manager", "pm ", "it manager", "tech lead", "it consultant", "quản trị dự án")),
    ("Designing", ("designer", "thiết kế", "ui/ux", "figma")),
    ("Testing", ("tester", "qa", "qc", "kiểm thử", "quality assurance")),
    ("Cloud & Infrastructure", ("system engineer", "system admin", "sysadmin", "devops", "cloud engineer", "aws", "azure", "network")),
    ("Data Analytics", ("data engineer", "data analyst", "data scientist", "bi analyst", "database", "phân tích dữ liệu")),
    ("AI & Blockchain", ("ai engineer", "machine learning", "blockchain", "trí tuệ nhân tạo", "deep learning")),
    ("Helpdesk", ("erp", "solution architect", "it support", "helpdesk", "hỗ trợ kỹ thuật")),
    ("IT - Khác", ("erp", "solution architect")),
)

RANK_V2 = (
    ("Internship", ("thực tập", "intern", "sinh viên", "cộng tác viên")),
    ("Leader", ("leader", "team lead", "trưởng nhóm", "manager", "giám đốc", "trưởng phòng", "quản lý", "giám sát", "chi nhánh")),
    ("Project Manager", ("project manager", " pm")),
    ("Senior", ("senior", "sr.", "cao cấp", "chuyên gia")),
    ("Mid-level", ("mid-level", "middle")),
    ("Fresher", ("fresher", "mới tốt nghiệp", "mới đi làm")),
)

EMPLOYMENT_V2 = (
    ("Freelance", ("freelance", "tự do", "ctv", "thời vụ")),
    ("Part-time", ("part time", "bán thời gian", "parttime")),
)
WORK_MODE_V2 = (
    ("Hybrid", ("hybrid", "linh hoạt")),
    ("Remote", ("remote", "từ xa", "wfh")),
)

# title noise removed before classification (regular expressions, applied in order)
TITLE_NOISE_V2 = (r"tuyển\s*gấp", r"cần\s*tuyển", r"hot", r"urgent", r"lương\s*.*", r"\d+\s*-\s*\d+\s*(triệu|usd)")

# ---------------------------------------------------------------------------
# FIXED VALUES -- shared by v1 and v2
# ---------------------------------------------------------------------------

HEADCOUNT_BULK = ("nhiều", "số lượng lớn", "vô hạn", "không giới hạn", "hàng loạt")
HEADCOUNT_TITLE_PATTERNS = (
    r"tuyển\s+(\d+)",
    r"(\d+)\s+vị trí",
    r"(\d+)\s+nhân sự",
    r"(\d+)\s+nhân viên",
    r"(\d+)\s+người",
    r"(\d+)\s+bạn",
    r"(\d+)\s+slot",
    r"(\d+)\s+kỹ sư",
    r"(\d+)\s+chuyên viên",
    r"(\d+)\s+kỹ thuật viên",
    r"số lượng\s*[:\-]?\s*(\d+)",
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- v1 (older pipeline)
# ---------------------------------------------------------------------------

# keyword -> merged province (v1: 87 entries)
PROVINCE_MERGE_V1 = (
    ("kiên giang", "An Giang"), ("an giang", "An Giang"),
    ("bạc liêu", "Cà Mau"), ("cà mau", "Cà Mau"),
    ("bình phước", "Đồng Nai"), ("đồng nai", "Đồng Nai"),
    ("tiền giang", "Đồng Tháp"), ("đồng tháp", "Đồng Tháp"),
    ("long an", "Tây Ninh"), ("tây ninh", "Tây Ninh"),
    ("bến tre", "Vĩnh Long"), ("trà vinh", "Vĩnh Long"), ("vĩnh long", "Vĩnh Long"),
    ("sóc trăng", "TP. Cần Thơ"), ("hậu giang", "TP. Cần Thơ"), ("cần thơ", "TP. Cần Thơ"),
    ("tp. cần thơ", "TP. Cần Thơ"), ("tp cần thơ", "TP. Cần Thơ"),
    ("phú yên", "Đắk Lắk"), ("đắk lắk", "Đắk Lắk"), ("dak lak", "Đắk Lắk"),
    ("bình định", "Gia Lai"), ("gia lai", "Gia Lai"),
    ("ninh thuận", "Khánh Hoà"), ("khánh hoà", "Khánh Hoà"), ("khánh hòa", "Khánh Hoà"), ("nha trang", "Khánh Hoà"),
    ("đắk nông", "Lâm Đồng"), ("dak nong", "Lâm Đồng"), ("bình thuận", "Lâm Đồng"), ("lâm đồng", "Lâm Đồng"),
    ("đà lạt", "Lâm Đồng"),
    ("kon tum", "Quảng Ngãi"), ("quảng ngãi", "Quảng Ngãi"),
    ("quảng bình", "Quảng Trị"), ("quảng trị", "Quảng Trị"),
    ("quảng nam", "TP. Đà Nẵng"), ("đà nẵng", "TP. Đà Nẵng"), ("tp. đà nẵng", "TP. Đà Nẵng"), ("tp đà nẵng", "TP. Đà Nẵng"),
    ("thừa thiên huế", "TP. Huế"), ("huế", "TP. Huế"), ("tp. huế", "TP. Huế"), ("tp huế", "TP. Huế"),
    ("bắc giang", "Bắc Ninh"), ("bắc ninh", "Bắc Ninh"),
    ("thái bình", "Hưng Yên"), ("hưng yên", "Hưng Yên"),
    ("yên bái", "Lào Cai"), ("lào cai", "Lào Cai"),
    ("hà nam", "Ninh Bình"), ("nam định", "Ninh Bình"), ("ninh bình", "Ninh Bình"),
    ("hòa bình", "Phú Thọ"), ("vĩnh phúc", "Phú Thọ"), ("phú thọ", "Phú Thọ"),
    ("bắc kạn", "Thái Nguyên"), ("bắc cạn", "Thái Nguyên"), ("thái nguyên", "Thái Nguyên"),
    ("hà giang", "Tuyên Quang"), ("tuyên quang", "Tuyên Quang"),
    ("hải dương", "TP. Hải Phòng"), ("hải phòng", "TP. Hải Phòng"), ("tp. hải phòng", "TP. Hải Phòng"),
    ("hà nội", "TP. Hà Nội"), ("hn", "TP. Hà Nội"), ("tp. hà nội", "TP. Hà Nội"), ("tp hà nội", "TP. Hà Nội"),
    ("bình dương", "TP. Hồ Chí Minh"), ("bà rịa", "TP. Hồ Chí Minh"), ("vũng tàu", "TP. Hồ Chí Minh"),
    ("bà rịa - vũng tàu", "TP. Hồ Chí Minh"), ("hồ chí minh", "TP. Hồ Chí Minh"), ("hcm", "TP. Hồ Chí Minh"),
    ("tphcm", "TP. Hồ Chí Minh"), ("sg", "TP. Hồ Chí Minh"), ("sài gòn", "TP. Hồ Chí Minh"),
    ("tp. hồ chí minh", "TP. Hồ Chí Minh"),
    ("cao bằng", "Cao Bằng"), ("điện biên", "Điện Biên"), ("hà tĩnh", "Hà Tĩnh"),
    ("lai châu", "Lai Châu"), ("lạng sơn", "Lạng Sơn"), ("nghệ an", "Nghệ An"),
    ("quảng ninh", "Quảng Ninh"), ("sơn la", "Sơn La"), ("thanh hóa", "Thanh Hóa"),
)

# keyword -> (region, latitude, longitude, display name) of the original province (v1: 66 entries)
PROVINCE_COORD_V1 = (
    ("hà nội", "Bắc", 21.0285, 105.8542, "TP. Hà Nội"), ("hn", "Bắc", 21.0285, 105.8542, "TP. Hà Nội"),
    ("bắc giang", "Bắc", 21.2731, 106.1946, "Bắc Giang"),
    ("bắc ninh", "Bắc", 21.1861, 106.0763, "Bắc Ninh"),
    ("hải dương", "Bắc", 20.9409, 106.3330, "Hải Dương"),
    ("hưng yên", "Bắc", 20.9333, 106.3167, "Hưng Yên"),
    ("hải phòng", "Bắc", 20.8449, 106.6881, "TP. Hải Phòng"),
    ("vĩnh phúc", "Bắc", 21.3093, 105.6053, "Vĩnh Phúc"),
    ("thái nguyên", "Bắc", 21.5672, 105.8244, "Thái Nguyên"),
    ("thái bình", "Bắc", 20.4475, 106.3364, "Thái Bình"),
    ("nam định", "Bắc", 20.4200, 106.1683, "Nam Định"),
    ("ninh bình", "Bắc", 20.2541, 105.9751, "Ninh Bình"),
    ("hà nam", "Bắc", 20.5453, 105.9122, "Hà Nam"),
    ("phú thọ", "Bắc", 21.3220, 105.2280, "Phú Thọ"),
    ("hòa bình", "Bắc", 20.8172, 105.3377, "Hòa Bình"),
    ("bắc kạn", "Bắc", 22.1472, 105.8364, "Bắc Kạn"),
    ("tuyên quang", "Bắc", 21.8251, 105.2155, "Tuyên Quang"),
    ("lào cai", "Bắc", 22.4851, 103.9707, "Lào Cai"),
    ("yên bái", "Bắc", 21.7229, 104.9113, "Yên Bái"),
    ("lạng sơn", "Bắc", 21.8538, 106.7607, "Lạng Sơn"),
    ("cao bằng", "Bắc", 22.6667, 106.2500, "Cao Bằng"),
    ("hà giang", "Bắc", 22.8233, 104.9839, "Hà Giang"),
    ("sơn la", "Bắc", 21.3283, 103.9015, "Sơn La"),
    ("lai châu", "Bắc", 22.4014, 103.2736, "Lai Châu"),
    ("điện biên", "Bắc", 21.3850, 103.0210, "Điện Biên"),
    ("quảng ninh", "Bắc", 20.9500, 107.0833, "Quảng Ninh"),
    ("thanh hóa", "Trung", 19.8077, 105.7765, "Thanh Hóa"), ("nghệ an", "Trung", 18.6734, 105.6791, "Nghệ An"),
    ("hà tĩnh", "Trung", 18.3427, 105.9058, "Hà Tĩnh"), ("quảng bình", "Trung", 17.4833, 106.6000, "Quảng Bình"),
    ("quảng trị", "Trung", 16.7423, 107.1856, "Quảng Trị"), ("huế", "Trung", 16.4637, 107.5909, "TP. Huế"),
    ("đà nẵng", "Trung", 16.0544, 108.2022, "TP. Đà Nẵng"), ("quảng nam", "Trung", 15.5804, 108.4816, "Quảng Nam"),
    ("quảng ngãi", "Trung", 15.1205, 108.7923, "Quảng Ngãi"), ("bình định", "Trung", 13.7830, 109.2197, "Bình Định"),
    ("phú yên", "Trung", 13.0882, 109.0913, "Phú Yên"), ("khánh hòa", "Trung", 12.2388, 109.1967, "Khánh Hoà"),
    ("ninh thuận", "Trung", 11.5647, 108.9902, "Ninh Thuận"), ("bình thuận", "Trung", 10.9333, 108.1000, "Bình Thuận"),
    ("kon tum", "Trung", 14.3500, 108.0000, "Kon Tum"), ("gia lai", "Trung", 13.9833, 108.0000, "Gia Lai"),
    ("đắk lắk", "Trung", 12.6667, 108.0500, "Đắk Lắk"), ("đắk nông", "Trung", 12.0000, 107.6833, "Đắk Nông"),
    ("lâm đồng", "Trung", 11.9404, 108.4583, "Lâm Đồng"),
    ("hcm", "Nam", 10.8231, 106.6297, "TP. Hồ Chí Minh"), ("hồ chí minh", "Nam", 10.8231, 106.6297, "TP. Hồ Chí Minh"),
    ("bình dương", "Nam", 10.9805, 106.6576, "Bình Dương"), ("đồng nai", "Nam", 10.9574, 106.8427, "Đồng Nai"),
    ("bà rịa", "Nam", 10.3460, 107.0843, "Bà Rịa - Vũng Tàu"), ("vũng tàu", "Nam", 10.3460, 107.0843, "Bà Rịa - Vũng Tàu"),
    ("tây ninh", "Nam", 11.3667, 106.1167, "Tây Ninh"), ("bình phước", "Nam", 11.5333, 106.9000, "Bình Phước"),
    ("long an", "Nam", 10.5333, 106.4000, "Long An"), ("tiền giang", "Nam", 10.3592, 106.3653, "Tiền Giang"),
    ("bến tre", "Nam", 10.2373, 106.3752, "Bến Tre"), ("trà vinh", "Nam", 9.9372, 106.3421, "Trà Vinh"),
    ("vĩnh long", "Nam", 10.2541, 105.9723, "Vĩnh Long"), ("đồng tháp", "Nam", 10.4564, 105.6425, "Đồng Tháp"),
    ("an giang", "Nam", 10.3759, 105.4185, "An Giang"), ("cần thơ", "Nam", 10.0452, 105.7469, "TP. Cần Thơ"),
    ("hậu giang", "Nam", 9.7842, 105.4700, "Hậu Giang"), ("sóc trăng", "Nam", 9.6033, 105.9722, "Sóc Trăng"),
    ("kiên giang", "Nam", 10.0076, 105.0869, "Kiên Giang"), ("bạc liêu", "Nam", 9.2922, 105.7249, "Bạc Liêu"),
    ("cà mau", "Nam", 9.1755, 105.1522, "Cà Mau"),
)

INDUSTRY_V1 = (
    ("Tài chính - Ngân hàng", ("đầu tư", "kế toán", "kiểm toán", "thuế", "ngân hàng", "chứng khoán", "tài chính", "bảo hiểm", "audit")),
    ("Sản xuất & Kỹ thuật", (
        "sản xuất", "vận hành sản xuất", "cơ khí", "ô tô", "tự động hóa", "điện / điện tử", "điện lạnh",
        "điện công nghiệp", "bảo trì", "sửa chữa", "dệt may", "da giày", "thời trang", "gỗ", "nội thất", "dầu khí",
        "khoáng sản", "năng lượng", "hóa học", "công nghiệp", "nông nghiệp", "nông lâm ngư nghiệp",
        "kỹ thuật ứng dụng", "quản lý chất lượng", "qa/qc", "khu công nghiệp")),
    ("Thương mại điện tử & Bán lẻ", (
        "bán lẻ", "bán sỉ", "hàng tiêu dùng", "fmcg", "thực phẩm", "đồ uống", "hàng gia dụng", "chăm sóc cá nhân",
        "thương mại tổng hợp", "siêu thị", "thương mại điện tử", "e-commerce", "retail")),
    ("Y tế & Sức khỏe", (
        "y tế", "dược", "bệnh viện", "chăm sóc sức khỏe", "thẩm mỹ", "làm đẹp", "công nghệ sinh học", "hóa mỹ phẩm",
        "nha khoa", "healthcare", "pharma")),
    ("Xây dựng & Bất động sản", ("real estate", "xây dựng", "bất động sản", "kiến trúc", "thiết kế nội thất", "vật liệu xây dựng")),
    ("Vận tải & Logistics", ("vận chuyển", "giao nhận", "kho vận", "logistics", "kho bãi", "hàng không", "xuất nhập khẩu", "thu mua", "vật tư", "chuỗi cung ứng")),
    ("Dịch vụ & Giải trí", ("du lịch", "nhà hàng", "khách sạn", "nghệ thuật", "thiết kế", "giải trí", "truyền hình", "báo chí", "biên tập", "xuất bản", "in ấn", "tổ chức sự kiện")),
    ("Giáo dục & Đào tạo", ("giáo dục", "đào tạo", "thư viện", "trường học", "trung tâm anh ngữ")),
    ("Marketing & Truyền thông", ("marketing", "tiếp thị", "quảng cáo", "truyền thông", "đối ngoại", "pr", "agency", "digital marketing")),
    ("Dịch vụ doanh nghiệp", ("nhân sự", "hành chính", "thư ký", "luật", "pháp lý", "biên phiên dịch", "thông dịch", "tư vấn", "dịch vụ khách hàng")),
    ("Công nghệ & Viễn thông", ("cntt", "phần mềm", "phần cứng", "mạng", "viễn thông", "bưu chính viễn thông", "internet", "online", "game", "it - phần mềm", "it - phần cứng")),
    ("Kinh doanh / Sales", ("bán hàng", "kinh doanh", "sales", "phát triển thị trường")),
)

JOB_TITLE_V1 = (
    ("Project Manager", ("project manager", "pm ", "pm)", "quản lý dự án", "pmo", "điều phối dự án", "quản trị dự án")),
    ("Project Leader", ("project leader", "trưởng dự án")),
    ("IT Manager", ("it manager", "trưởng phòng it", "giám đốc công nghệ", "cto", "cio", "trưởng bộ phận it", "trưởng phòng công nghệ", "it section manager")),
    ("Tech Lead", ("tech lead", "technical lead", "trưởng nhóm kỹ thuật", "team lead")),
    ("IT Consultant", ("it consultant", "tư vấn giải pháp", "tư vấn công nghệ", "tư vấn kỹ thuật", "triển khai phần mềm", "technical consultant", "giải pháp phần mềm")),
    ("Product Owner", ("product owner", "po ", "quản lý sản phẩm", "giám đốc sản phẩm", "product executive", "phát triển sản phẩm")),
    ("Product Manager", ("product manager", "quản lý sản phẩm", "giám đốc sản phẩm")),
    ("Product Executive", ("product executive", "phát triển sản phẩm")),
    ("Business Analyst", ("business analyst", "ba ", "ba)", "phân tích nghiệp vụ", "phân tích kinh doanh", "business data analyst")),
    ("Full-stack Developer", ("fullstack", "full-stack", "full stack")),
    ("Back-end Developer", ("backend", "back-end", "back end", "python developer")),
    ("Front-end Developer", ("frontend", "front-end", "front end", "web developer")),
    ("Mobile Developer", ("mobile", "android", "ios", "flutter", "react native", "swift", "kotlin", "xamarin")),
    ("Game Developer", ("game developer", "unity")),
    ("Embedded Engineer", ("embedded", "nhúng", "firmware", "iot", "vi mạch", "lập trình máy cnc", "plc", "scada")),
    ("Tester", ("tester", "kiểm thử", "manual test", "test engineer")),
    ("QA - QC", ("qa", "qc", "quality assurance", "quality control", "pqa", "đảm bảo chất lượng")),
    ("DevOps Engineer/DevSecOps Engineer", ("devops", "sre", "devsecops", "ci/cd", "site reliability")),
    ("Cloud Engineer", ("cloud engineer", "aws", "azure", "gcp", "kỹ sư đám mây")),
    ("System Engineer", ("system engineer", "kỹ sư mạng", "an ninh mạng", "security", "bảo mật", "hạ tầng")),
    ("System Admin", ("system admin", "sysadmin", "quản trị hệ thống")),
    ("Data Engineer", ("data engineer", "kỹ sư dữ liệu", "big data", "etl", "kĩ sư dữ liệu")),
    ("Data Analyst", ("data analyst", "phân tích dữ liệu", "chuyên viên phân tích dữ liệu")),
    ("Data Scientist", ("data scientist", "khoa học dữ liệu")),
    ("Business Intelligence Analyst", ("business intelligence", "bi analyst", "bi executive")),
    ("Database Engineer", ("dba", "database", "cơ sở dữ liệu", "sql developer", "quản trị csdl")),
    ("AI Engineer", ("ai engineer", "trí tuệ nhân tạo", "machine learning")),
    ("Blockchain Engineer", ("blockchain", "computer vision", "nlp", "smart contract", "web3", "solidity")),
    ("Designer", ("designer", "thiết kế", "ui/ux", "graphic", "đồ họa", "art director", "artist")),
    ("ERP Engineer/ERP Consultant", ("erp", "sap", "odo", "salesforce", "crm developer")),
    ("Solution Architect", ("solution architect", "kiến trúc sư", "kiến trúc hệ thống")),
    ("IT Support", ("it support", "helpdesk", "hỗ trợ kỹ thuật", "kỹ thuật máy tính", "sửa chữa", "lắp ráp", "kỹ thuật viên", "it phần cứng", "it helpdesk")),
)

# v1 title noise: regular expressions removed (replaced by "") in order
TITLE_NOISE_V1 = (r"tuyển", r"gấp", r"hcm", r"hn", r"fulltime", r"remote", r"lương", r"tại", r"\[.*?\]", r"\(.*?\)")

# v1 skill keywords are used as raw regular expressions
SKILLS_V1 = {
    "hard": (
        ("Python", ("python",)),
        ("Java", ("java ", "java,")),
        ("Go/Golang", ("golang", "go lang")),
        ("JavaScript", ("javascript", "js ", "js,", "js.")),
        ("TypeScript", ("typescript", "ts")),
        ("C++", (r"c\+\+",)),
        ("C#", ("c#", ".net", "dotnet")),
        ("PHP", ("php",)),
        ("Ruby", ("ruby", "rails")),
        ("Swift", ("swift",)),
        ("Kotlin", ("kotlin",)),
        ("Dart", ("dart", "flutter")),
        ("R", ("r lang", "r programming")),
        ("SQL", ("sql", "mysql", "postgres", "sql server", "nosql", "mongodb", "redis")),
        ("HTML/CSS", ("html", "css")),
        ("Rust", ("rust",)),
        ("Scala", ("scala",)),
        ("Bash/Shell", ("bash", "shell script", "linux")),
        ("PowerShell", ("powershell",)),
        ("VBA", ("vba", "excel macro")),
        ("MATLAB", ("matlab",)),
        ("Assembly", ("assembly", "asm")),
        ("React", ("react", "reactjs", "react.js", "react native")),
        ("Angular", ("angular",)),
        ("Vue", ("vue", "vuejs")),
        ("NodeJS", ("node", "nodejs", "node.js")),
        ("Spring", ("spring boot", "spring mvc")),
        ("Django/Flask", ("django", "flask")),
        ("AWS", ("aws", "amazon web services")),
        ("Azure", ("azure",)),
        ("GCP", ("gcp", "google cloud")),
        ("Docker", ("docker",)),
        ("Kubernetes", ("k8s", "kubernetes")),
        ("Git", ("git", "github", "gitlab", "svn")),
        ("Excel", ("excel", "spreadsheet", "google sheet", "google sheets", "vlookup", "pivot table")),
        ("Power BI", ("power bi", "powerbi", "dax", "power query")),
        ("Tableau", ("tableau",)),
        ("Looker", ("looker", "google data studio")),
        ("Qlik", ("qlik", "qlikview", "qliksense")),
        ("SAS/SPSS", ("sas", "spss")),
        ("Jira/Confluence", ("jira", "confluence", "atlassian")),
        ("Trello/Asana", ("trello", "asana", "monday.com")),
        ("Office/Tin học", ("word", "powerpoint", "ms office", "tin học văn phòng")),
        ("Design Tool", ("figma", "photoshop", "adobe xd", "sketch")),
    ),
    "soft": (
        ("Giao tiếp", ("giao tiếp", "communication", "trình bày", "thuyết trình", "presentation")),
        ("Lãnh đạo", ("lãnh đạo", "leadership", "dẫn dắt", "quản lý nhóm", "team lead")),
        ("Thương lượng", ("thương lượng", "đàm phán", "negotiation")),
        ("Giải quyết vấn đề", ("giải quyết vấn đề", "problem solving", "xử lý tình huống")),
        ("Tư duy phản biện", ("phản biện", "critical thinking", "tư duy logic")),
        ("Sáng tạo", ("sáng tạo", "creative", "innovation")),
        ("Quản lý thời gian", ("quản lý thời gian", "time management", "sắp xếp công việc")),
        ("Làm việc nhóm", ("làm việc nhóm", "teamwork", "team work", "hòa đồng")),
        ("Chịu áp lực", ("chịu được áp lực", "work under pressure", "áp lực cao")),
        ("Tự học", ("tự học", "self-learning", "thích nghi", "ham học hỏi")),
        ("Tiếng Anh", ("tiếng anh", "english", "toeic", "ielts", "toefl")),
        ("Tiếng Nhật", ("tiếng nhật", "japanese", "n1", "n2", "n3")),
        ("Tiếng Trung", ("tiếng trung", "chinese", "hsk")),
        ("Tiếng Hàn", ("tiếng hàn", "korean", "topik")),
    ),
}

RANK_V1 = (
    ("Thực tập sinh", ("thực tập", "intern", "trainee")),
    ("Giám đốc", ("giám đốc", "director", "ceo", "c-level", "head of")),
    ("Phó giám đốc", ("phó giám đốc", "vp ", "vice president")),
    ("Trưởng phòng", ("trưởng phòng", "manager", "lead", "trưởng nhóm", "quản lý")),
)

EDUCATION_V1 = (
    ("Trung cấp", ("trung cấp",)),
    ("Cao đẳng", ("cao đẳng",)),
    ("Đại học", ("đại học", "cử nhân", "kỹ sư", "bachelor")),
    ("Thạc sĩ", ("thạc sĩ", "master")),
)

EMPLOYMENT_V1 = (
    ("Freelance", ("freelance", "freelancer", "tự do", "cộng tác viên", "ctv", "project base", "theo dự án", "thời vụ")),
    ("Part-time", ("part time", "part-time", "bán thời gian", "ca gãy", "4 tiếng", "parttime")),
    ("Full-time", ("full time", "full-time", "toàn thời gian", "chính thức", "hành chính")),
)
WORK_MODE_V1 = (
    ("Hybrid", ("hybrid", "linh hoạt", "xen kẽ", "flexible", "kết hợp", "mix", "bán từ xa", "semi-remote", "ngày lên văn phòng", "days at office")),
    ("Remote", ("remote", "từ xa", "wfh", "work from home", "tại nhà", "không cần lên văn phòng")),
    ("Onsite", ("onsite", "tại văn phòng", "office", "trực tiếp", "offline")),
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- bands (lower edge inclusive, label); last band open-ended
# ---------------------------------------------------------------------------

SALARY_BANDS_V1 = ((3, "Dưới 3 triệu"), (10, "3 - 10 triệu"), (15, "10 - 15 triệu"), (25, "15 - 25 triệu"),
                   (35, "25 - 35 triệu"), (50, "35 - 50 triệu"), (None, "Hơn 50 triệu"))
SALARY_BANDS_V2 = ((3, "Dưới 3 triệu"), (10, "3 - 10 triệu"), (20, "10 - 20 triệu"), (35, "20 - 35 triệu"),
                   (50, "35 - 50 triệu"), (None, "Hơn 50 triệu"))
EXPERIENCE_BANDS_V1 = ((1, "Dưới 1 năm"), (3, "1 – 3 năm"), (5, "3 – 5 năm"), (None, "Trên 5 năm"))
EXPERIENCE_BANDS_V2 = ((1, "Dưới 1 năm"), (3, "1 - 3 năm"), (5, "3 - 5 năm"), (None, "Trên 5 năm"))
SIZE_BANDS_V1 = ((10, "Dưới 10 nhân viên"), (100, "10 - 100 nhân viên"), (500, "100 - 500 nhân viên"),
                 (1000, "500 - 1000 nhân viên"), (5000, "1000 - 5000 nhân viên"), (None, "Trên 5000 nhân viên"))
SIZE_CLASS_V2 = ((10, "Siêu nhỏ"), (100, "Nhỏ"), (500, "Trung bình thấp"), (1000, "Trung bình cao"),
                 (5000, "Lớn"), (10000, "Rất lớn"), (None, "Tập đoàn"))

# ---------------------------------------------------------------------------
# FIXED VALUES -- other parser keywords
# ---------------------------------------------------------------------------

SALARY_UPTO_V1 = ("đến", "tới", "up to", "dưới", "max")
SALARY_FROM_V1 = ("từ", "trên", "hơn", "min")
SALARY_UPTO_V2 = ("đến", "tới", "up to", "max", "dưới")
SALARY_FROM_V2 = ("từ", "min", "from", "trên")
NO_EXPERIENCE_V1 = ("không yêu cầu", "no experience", "chưa có")
NO_EXPERIENCE_V1_EXTENDED = ("không yêu cầu", "chưa có kinh nghiệm", "không cần kinh nghiệm", "no experience")
NO_EXPERIENCE_V2 = ("không yêu cầu", "no experience")
DEADLINE_DEFAULT_WORDS_V2 = ("na", "null", "thỏa thuận", "không", "nan")
DEADLINE_DEFAULT_DAYS_V2 = 30

# page size of the listing site that states a result count
LISTING_PAGE_SIZE = 50
# per-run caps on new postings
NEW_POSTINGS_CAP = {"site_a": 100, "site_b": 20, "site_c": 10}
MAX_CONSECUTIVE_EMPTY_PAGES = 5
