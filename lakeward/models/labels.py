"""Fixed values the warehouse models must reproduce exactly: output column
names, raw spreadsheet column names read from staging, status labels and
band labels.  They are data of the warehouse contract, kept here together in
their natural order."""

# Output column names of dim_ar (employee code, employee name).
AR_ID_COL = "mã a&r"
AR_NAME_COL = "tên a&r"

# Raw column names of the spreadsheet-fed staging tables.
PARTNER_NAME_COL = "Tên đối tác"          # partners, purchase_cost
SONG_CODE_COL = "Mã bài"                  # resource_before_odoo
AVG_SCORE_COL = "Điểm trung bình"         # resource_before_odoo
UNIT_COST_COL = "Chi phí đv: $"           # resource_before_odoo
AR_IN_CHARGE_COL = "A&R phụ trách"        # resource_before_odoo
ARTIST_COL = "Nghệ sỹ"                    # resource_before_odoo
YEAR_TOTAL_COL = "Total năm"              # purchase_cost
MONTH_COST_PREFIX = "CP tháng "           # purchase_cost: "CP tháng 1" .. "CP tháng 12"

# Resource status labels (dim_resource):
# approved and production state 6 -> not accepted; approved otherwise -> accepted;
# draft -> in production; rejected -> not accepted.
STATUS_NOT_ACCEPTED = "Không nghiệm thu"
STATUS_ACCEPTED = "Đã nghiệm thu"
STATUS_IN_PRODUCTION = "Đang sản xuất"
REJECTED_PRODUCE_STATE = 6

# Review conclusion labels by code 0, 1, 2, 3
# (not concluded, passed, failed, needs changes).
CONCLUSION_LABELS = {0: "Chưa kết luận", 1: "Đạt", 2: "Không đạt", 3: "Cần sửa"}

# Department level name that marks a company.
COMPANY_LEVEL_NAME = "Công ty"

# Recipient label written on every distribution row ("shared").
SHARED_RECIPIENT = "Dùng chung"

# Resource type labels (purchased vs produced).
RESOURCE_PURCHASED = "Thu mua"
RESOURCE_PRODUCED = "Sản xuất"

# Inventory age groups (upper bounds in days 30, 60, then the rest).
INVENTORY_AGE_BOUNDS = (30, 60)
INVENTORY_AGE_LABELS = ("Tồn kho 0-30 ngày", "Tồn kho 30-60 ngày", "Tồn kho > 60 ngày")

# Acceptance score groups (lower bounds 9.75, 9.25, 8.75, 8.25, 7.75, then the rest).
SCORE_BOUNDS = (9.75, 9.25, 8.75, 8.25, 7.75)
SCORE_LABELS = ("10 điểm", "9.5 điểm", "9 điểm", "8.5 điểm", "8 điểm", "Khác/chưa có điểm")

# Usage status labels (used at least once / never used).
USED = "Đã từng sử dụng"
NEVER_USED = "Chưa từng sử dụng"

# Spreadsheet error tokens treated as missing.
SHEET_ERRORS = ("#N/A", "#REF!")

# URL prefixes for videos and channels.
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
CHANNEL_URL_PREFIX = "https://www.youtube.com/channel/"

# Stock code prefix of catalogue files and its full pattern
# (prefix followed by 32 upper-case hex digits).
STOCK_PREFIX = "HGFA"
STOCK_CODE_PATTERN = "^HGFA[0-9A-F]{32}$"

# Local currency amounts are divided by this rate.
LOCAL_CURRENCY_RATE = 25000.0

# Unbounded ``numeric`` of the source SQL; values are rounded to six places here.
NUMERIC = "decimal(38,6)"

# Raw column names of the stock spreadsheets read by dim_stock.
PERF_STOCK_COL = "Mã Stock"               # resource_performance
PERF_NAME_COL = "Tên bài"
PERF_ISRC_COLS = ("ISRC chốt", "ISRC (Stock cũ)", "ISRC (Stock mới)")   # in priority order
PERF_PROJECT_COL = "Dự án chốt"
UNKNOWN_PROJECT = "không xác định"        # "unknown", compared NFC-normalised, lower case
RBO_STOCK_COL = "HG_Stock_ID"             # resource_before_odoo
RBO_TITLE_COL = "Tên bài gốc"
PURCHASED_CODE_COL = "Mã"                 # purchased_resource
TITLE_COL = "Tiêu đề"                     # purchased_resource, resource_infomation_add
STOCK_CODE_LOOSE = "^HGFA[A-F0-9]+$"

# Stock lifecycle status (archived, in inventory, cold, in use)
# and the storage status that marks an archived file.
STOCK_ARCHIVED = "Lưu kho"
STOCK_IN_INVENTORY = "Tồn kho"
STOCK_COLD = "Hàng nguội"
STOCK_IN_USE = "Sử dụng"
ARCHIVED_STATUS = "Archived"
COLD_AFTER_DAYS = 30

# Project columns and the project values that are not projects
# (dim_project): "unknown", "drop this song", and the header word "project".
PROJECT_COL = "Dự án"                     # partners, distro_infomation, resource_infomation_add
GENRE_COL = "Thể loại"                    # resource_before_odoo
NOT_PROJECTS = ("không xác định", "bỏ bài này", "dự án")
PROJECT_HEADER = "dự án"

# Partner sheet columns read by dim_purchased_resource
# (stock repository name, contract date, pricing method) and the name of the
# default sub-project ("no sub-project"), compared as a normalised key.
PARTNER_REPO_COL = "Tên kho trên HG Stock"
CONTRACT_DATE_COL = "Ngày ký HĐ"
PRICING_COL = "Cách tính giá"
PURCHASED_REPO_COL = "Repository"
DEFAULT_SUB_PROJECT_KEY = "không có dự án con"

# Sheets, names and ids of sub-projects and repositories.
PERF_SUB_PROJECT_COL = "Dự án con (nếu có)"
PERF_REPO_COL = "Kho (nếu có)"
SUBGENRE_COL = "Subgenre"
SUB_PROJECT_COL = "Dự án con"
REPO_COL = "Kho"
DEFAULT_SUB_PROJECT = "Không có dự án con"
DEFAULT_REPOSITORY = "Không có kho"
NO_SUB_PROJECT = ("không có", "khong co")
SUB_PROJECT_HEADER = "dự án con"
REPO_HEADER = "kho"
AUDIOJUNGLE = "Audiojungle"
AUDIOJUNGLE_SPELLINGS = ("audiojungle", "nhạc nền audiojungle", "nhạc nền tảng audiojungle", "nền tảng audiojungle")
PROJECT_ID_OVERRIDES = {"129": "163"}
SUB_PROJECT_ALIASES = (("classical", "classcial bật cid", "classical bật cid"),)

# Columns and words that dim_resources reads on the sheets.
RBO_ISRC_COL = "ISRC"
RBO_ACCEPTED_COL = "Ngày nghiệm thu"      # resource_before_odoo, resource_performance
RBO_STATUS_COL = "Tình trạng nghiệm thu"
PERF_SONG_COL = "Mã BH"
PERF_SCORE_COL = "Điểm nghiệm thu"
PERF_COST_COL = "Chi phí sx"
RESOURCE_FILE_COL = "ResourceFileId"      # resource_infomation_add
SONG_CODE_PATTERN = r"^[0-9]{4}_[A-Z0-9]+\([0-9]+_[A-Z]+_[A-Z]+\)_[A-Z]+_[0-9]+_[A-Z]+$"
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
STOCK_NOT_FOUND = "Không tìm thấy"
LAST_ACCEPTED_BEFORE_ODOO = "2025-08-31"
PRODUCTION_REPOSITORY = "Kho sản xuất"
DROPPED_PROJECTS = ("bỏ bài này", "bo bai nay")

# Resource sources (order system, catalogue, sheet before it, performance and added sheets).
SOURCE_ODOO = "odoo"
SOURCE_PURCHASED = "purchased"
SOURCE_BEFORE_ODOO = "before_odoo"
SOURCE_PERFORMANCE = "performance"
SOURCE_ADDED = "resource_information_add"

# Steps of the production flow (ordered, produced, accepted,
# published, used, result), with the prefix of their item keys, and done / not done.
FLOW_STEPS = (("OD->SX", "OD_SX"), ("SX->NT", "SX_NT"), ("NT->PP", "NT_PP"), ("PP->SD", "PP_SD"), ("SD->KQ", "SD_KQ"))
DONE, NOT_DONE = "Hoàn thành", "Chưa hoàn thành"
RELEASE_SENT = "sent"
