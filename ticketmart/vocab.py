"""Vocabulary of the data: word lists, column names, prices and categories.

Everything in this module is a fixed value. The texts have to equal what the
ticket system and the existing warehouse tables hold, so they are written out
as they are and in the order in which they came into use. The tables of column
names are in `data/columns.json`.
"""

from __future__ import annotations

import json
from importlib import resources

# --- fixed values: personal data -------------------------------------------

SENSITIVE_MARKERS = (
    "聯絡人 姓名",
    "聯絡人 Email",
    "聯絡人 手機",
    "Address",
)

# --- fixed values: ticket payload -------------------------------------------

TICKET_GROUPS = ("corporate", "individual", "reserved")

# payload fields that do not reach the wide tables
UNUSED_PAYLOAD_FIELDS = (
    "id",
    "ticket_id",
    "state",
    "checkin_code",
    "currency",
    "data",
    "ticket_type",
    "kyc",
    "id_number",
    "slot",
    "order_no",
)

PAYLOAD_RENAMES = {
    "reg_no": "registration_no",
    "ticket_name": "ticket_type",
    "is_paid": "payment_status",
}

NUMERIC_COLUMNS = (
    "price",
    "invoice_policy",
    "if_you_buy_the_ticket_with_pyckage",
    "vat_number_optional",
)

PRIVATE_COLUMNS = ("nickname", "address_size_of_tshirt_t")

PAID_TEXTS = ("True", "true", "1")

OFFLINE_PAID_TEXT = "已繳費"
OFFLINE_ORDER_KEY = "訂單編號"
OFFLINE_STATUS = "票券狀態"
OFFLINE_LIVE_STATUS = "activated"

OFFLINE_META_FIELDS = {
    "id": "Id",
    "ticket_name": "票種",
    "reg_no": "報名序號",
    "state": "票券狀態",
    "checkin_code": "檢查碼",
    "qrcode": "QR Code 序號",
    "is_paid": "付款狀態",
    "price": "票面價格",
    "payment_method": "付款方式",
    "updated_at": "付款時間",
    "ticket_type": "選用的取票方式",
    "order_no": "訂單編號",
}

# --- fixed values: column names over the years, from the data file ----------

_COLUMNS = json.loads(resources.files("ticketmart").joinpath("data/columns.json").read_text("utf-8"))

NAME_MAPPING: dict[str, str] = _COLUMNS["name_mapping"]
UNWANTED_COLUMNS = tuple(_COLUMNS["unwanted_columns"])

# The CSV loader for the years up to 2021 knows only the entries of its time.
NAME_MAPPING_2021: dict[str, str] = _COLUMNS["name_mapping_until_2021"]
UNWANTED_COLUMNS_2021 = tuple(_COLUMNS["unwanted_columns_until_2021"])

# Canonical columns per year and ticket group.
CANONICAL_CORE = tuple(_COLUMNS["canonical_core"])
CANONICAL_BY_YEAR = {
    int(year): tuple(names) for year, names in _COLUMNS["canonical_by_year"].items()
}
CANONICAL_EXTRA = {
    (int(place.split()[0]), place.split()[1]): tuple(names)
    for place, names in _COLUMNS["canonical_extra"].items()
}

CROSS_YEAR_EXTRAS = ("tags", "attendance_book")

# --- fixed values: price list -----------------------------------------------

TICKET_PRICES = {
    "企業票 - 一般階段 / Corporate - Regular Stage": 5800,
    "企業票 - 晚鳥階段 / Corporate - Final Stage": 6500,
    "企業團體票 (歡迎申請) / Group-Buy Corporate (Free to Apply)": 5220,
    "優惠票 (含紀念衣服) / Reserved - Community (with T-Shirt)": 2590,
    "貢獻者票 (含紀念衣服) / Reserved - Contributor (with T-Shirt)": 1290,
    "財務補助票 / Reserved - Financial Aid": 0,
    "邀請票 (含紀念衣服) / Reserved - Invited (with T-Shirt)": 0,
    "個人贊助票 (含紀念衣服) / Individual - Sponsor (with T-Shirt)": 5500,
    "個人票 - 早鳥 (含紀念衣服) / Individual - Early Stage (with T-Shirt)": 2790,
    "個人票 - 一般 (含紀念衣服)/ Individual - Regular Stage (with T-Shirt)": 3790,
    "個人票 - 晚鳥階段 / Individual - Final Stage": 4290,
    "愛心優待票 (含紀念衣服)/ Individual - Concession": 1895,
}

# --- fixed values: expenses and surveys -------------------------------------

EXPENSE_COLUMNS = (
    "Reason",
    "Price",
    "Remarks",
    "Team_name",
    "Details",
    "To_who",
    "Yes_or_No",
)

SURVEY_UNUSED_COLUMNS = (
    "額滿結束註記",
    "使用者紀錄",
    "會員時間",
    "會員編號",
    "自訂ID",
    "備註",
)
SURVEY_KEY = "IP紀錄"

# --- fixed values: labelling categories -------------------------------------

INDUSTRIES = {
    0: "未知",
    1: "批發／零售／傳直銷業",
    2: "文教相關業",
    3: "大眾傳播相關業",
    4: "旅遊／休閒／運動業",
    5: "一般服務業",
    6: "電子資訊／軟體／半導體相關業",
    7: "一般製造業",
    8: "農林漁牧水電資源業",
    9: "運輸物流及倉儲",
    10: "政治宗教及社福相關業",
    11: "金融投顧及保險業",
    12: "法律／會計／顧問／研發／設計業",
    13: "建築營造及不動產相關業",
    14: "醫療保健及環境衛生業",
    15: "礦業及土石採取業",
    16: "住宿／餐飲服務業",
}

JOB_CLASSES = {
    0: "其他 (Others): 一些較特殊的職位",
    1: "後端工程師 (Backend Engineer): 專注於伺服器端邏輯, 資料庫和 API 開發",
    2: "前端工程師 (Frontend Engineer): 專注於使用者介面和使用者體驗的開發",
    3: "全端工程師 (Full-Stack Engineer): 同時具備後端和前端開發能力",
    4: "行動應用開發工程師 (Mobile App Developer): 專注於 Android 和 iOS 平台的應用程式開發",
    5: "資料工程師 (Data Engineer): 負責資料的收集, 儲存, 處理和管道建設",
    6: "資料分析師/科學家 (Data Analyst/Scientist): 負責資料的分析, 洞察提取和模型建立",
    7: "AI/機器學習工程師/研究員 (AI/ML Engineer/Researcher): 專注於人工智慧, 機器學習演算法的開發, 應用和研究",
    8: "DevOps/SRE 工程師 (DevOps/SRE Engineer): 負責開發流程的自動化, 基礎設施的管理和系統的穩定性",
    9: "系統/網路工程師 (System/Network Engineer): 負責系統架設, 維護和網路管理",
    10: "嵌入式/韌體工程師 (Embedded/Firmware Engineer): 專注於硬體相關的軟體開發",
    11: "測試/品質保證工程師 (QA/Test Engineer): 負責軟體的測試, 品質保證和自動化測試",
    12: "技術主管/經理 (Technical Lead/Manager): 負責技術團隊的管理, 領導和技術方向的制定",
    13: "專案經理/產品經理 (Project Manager/Product Manager): 負責專案的規劃, 執行和產品的定義, 開發",
    14: "資料庫管理員 (DBA): 負責資料庫的設計, 維護和管理",
    15: "顧問/架構師 (Consultant/Architect): 提供技術諮詢, 解決方案設計和系統架構規劃",
    16: "研究人員/學者 (Researcher/Academic): 在學術界或研究機構進行研究工作",
    17: "業務/行銷/客戶成功 (Sales/Marketing/Customer Success): 負責業務拓展, 行銷推廣和客戶關係維護",
    18: "行政/管理 (Administrative/Management): 負責行政事務, 部門管理和組織運營",
    19: "設計師/藝術家 (Designer/Artist): 負責視覺設計, 使用者介面設計和藝術創作",
    20: "一般工程師: 難以歸類的工程師職位",
    21: "學生 (Intern): 實習生或學生職位",
}
