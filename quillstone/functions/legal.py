"""Names of Indian statutes and institutions, and the patterns of references, as data."""

from __future__ import annotations

# Fixed values, one to a line.
ACTS = """
Constitution of India
Income-tax Act, 1961
Income Tax Act, 1961
Income Tax Act
Income-tax Act
Direct Tax Vivad se Vishwas Act, 2020
Direct Taxes Code
Finance (No. 2) Act, 2019
Finance (No. 2) Act, 2014
Central Goods and Services Tax Act, 2017
Integrated Goods and Services Tax Act, 2017
Union Territory Goods and Services Tax Act, 2017
Goods and Services Tax (Compensation to States) Act, 2017
Central Goods and Services Tax Act
Customs Act, 1962
Central Excise Act, 1944
Customs Tariff Act, 1975
Black Money (Undisclosed Foreign Income and Assets) and Imposition of Tax Act, 2015
Prohibition of Benami Property Transactions Act, 1988
Benami Transactions (Prohibition) Act, 1988
Foreign Exchange Management Act, 1999
Foreign Exchange Regulation Act, 1973
Prevention of Money Laundering Act, 2002
Foreign Contribution (Regulation) Act, 2010
Foreign Contribution (Regulation) Act, 1976
Companies Act, 2013
Companies Act, 1956
Limited Liability Partnership Act, 2008
Insolvency and Bankruptcy Code, 2016
Securities and Exchange Board of India Act, 1992
Securities Contracts (Regulation) Act, 1956
Depositories Act, 1996
Reserve Bank of India Act, 1934
Banking Regulation Act, 1949
Negotiable Instruments Act, 1881
Securitisation and Reconstruction of Financial Assets and Enforcement of Security Interest Act, 2002
SARFAESI Act, 2002
Code of Civil Procedure, 1908
Code of Criminal Procedure, 1973
Bharatiya Nagarik Suraksha Sanhita, 2023
Bharatiya Nyaya Sanhita, 2023
Bharatiya Sakshya Adhiniyam, 2023
Indian Penal Code, 1860
Indian Evidence Act, 1872
Indian Contract Act, 1872
Specific Relief Act, 1963
Limitation Act, 1963
Transfer of Property Act, 1882
Registration Act, 1908
Industrial Disputes Act, 1947
Employees' Provident Funds and Miscellaneous Provisions Act, 1952
Payment of Gratuity Act, 1972
Minimum Wages Act, 1948
Factories Act, 1948
Code on Wages, 2019
Code on Social Security, 2020
Industrial Relations Code, 2020
Occupational Safety, Health and Working Conditions Code, 2020
Patents Act, 1970
Trade Marks Act, 1999
Copyright Act, 1957
Designs Act, 2000
Geographical Indications of Goods (Registration and Protection) Act, 1999
Right to Information Act, 2005
Prevention of Corruption Act, 1988
Lokpal and Lokayuktas Act, 2013
Arbitration and Conciliation Act, 1996
Consumer Protection Act, 2019
Competition Act, 2002
Real Estate (Regulation and Development) Act, 2016
Environment Protection Act, 1986
Information Technology Act, 2000
Telecom Regulatory Authority of India Act, 1997
Insurance Act, 1938
Insurance Laws (Amendment) Act, 2015
Stamp Act, 1899
Indian Stamp Act, 1899
Wealth Tax Act, 1957
Gift Tax Act, 1958
Interest Tax Act, 1974
Expenditure Tax Act, 1987
Smugglers and Foreign Exchange Manipulators (Forfeiture of Property) Act, 1976
Finance Act, 2017
Finance Act, 2018
Finance Act, 2019
Finance Act, 2020
Finance Act, 2021
Finance Act, 2022
Finance Act, 2023
Finance Act, 2024
Finance Act, 2025
""".strip().split("\n")

RULES = """
Income-tax Rules, 1962
Income Tax Rules, 1962
Companies (Accounts) Rules, 2014
Companies (Audit and Auditors) Rules, 2014
SEBI (Listing Obligations and Disclosure Requirements) Regulations, 2015
SEBI (Substantial Acquisition of Shares and Takeovers) Regulations, 2011
SEBI (Prohibition of Insider Trading) Regulations, 2015
FEMA (Non-Debt Instruments) Rules, 2019
FEMA (Debt Instruments) Regulations, 2019
Central Goods and Services Tax Rules, 2017
Customs (Import of Goods at Concessional Rate of Duty) Rules, 2017
Transfer Pricing Safe Harbour Rules
Advance Pricing Agreement Rules
""".strip().split("\n")

COURTS = """
Supreme Court of India
Delhi High Court
Bombay High Court
Madras High Court
Calcutta High Court
Allahabad High Court
Karnataka High Court
Gujarat High Court
Rajasthan High Court
Kerala High Court
Andhra Pradesh High Court
Telangana High Court
Patna High Court
Punjab and Haryana High Court
Gauhati High Court
Orissa High Court
Uttarakhand High Court
Jharkhand High Court
Chhattisgarh High Court
Himachal Pradesh High Court
Tripura High Court
Meghalaya High Court
Manipur High Court
Sikkim High Court
High Court of Delhi
High Court of Bombay
High Court of Madras
High Court of Calcutta
High Court of Allahabad
High Court of Karnataka
High Court of Gujarat
""".strip().split("\n")

TRIBUNALS = """
Income Tax Appellate Tribunal
ITAT
Authority for Advance Rulings
Board for Advance Rulings
National Company Law Tribunal
National Company Law Appellate Tribunal
NCLT
NCLAT
Debt Recovery Tribunal
Debt Recovery Appellate Tribunal
Securities Appellate Tribunal
Customs, Excise and Service Tax Appellate Tribunal
CESTAT
Appellate Authority for Advance Ruling
GST Appellate Authority
GST Council
Goods and Services Tax Appellate Tribunal
Appellate Tribunal for Foreign Exchange
Competition Commission of India
Competition Appellate Tribunal
Telecom Disputes Settlement and Appellate Tribunal
National Green Tribunal
Central Administrative Tribunal
Armed Forces Tribunal
Consumer Disputes Redressal Commission
National Consumer Disputes Redressal Commission
Insolvency and Bankruptcy Board of India
Real Estate Regulatory Authority
""".strip().split("\n")

REGULATORS = """
Central Board of Direct Taxes
CBDT
Central Board of Indirect Taxes and Customs
CBIC
Income Tax Department
Directorate of Income Tax
Directorate General of Income Tax Investigation
Principal Chief Commissioner of Income Tax
Chief Commissioner of Income Tax
Principal Commissioner of Income Tax
Commissioner of Income Tax
Assessing Officer
Transfer Pricing Officer
Dispute Resolution Panel
Reserve Bank of India
RBI
Securities and Exchange Board of India
SEBI
Insurance Regulatory and Development Authority of India
IRDAI
Pension Fund Regulatory and Development Authority
PFRDA
National Bank for Agriculture and Rural Development
NABARD
Small Industries Development Bank of India
SIDBI
Export-Import Bank of India
EXIM Bank
National Housing Bank
Ministry of Corporate Affairs
Registrar of Companies
Official Liquidator
Enforcement Directorate
Serious Fraud Investigation Office
SFIO
Financial Intelligence Unit
FIU-IND
Directorate of Enforcement
GST Network
GSTN
National Anti-Profiteering Authority
Government of India
Union of India
Ministry of Finance
Department of Revenue
Department of Economic Affairs
Department of Financial Services
Department of Commerce
Ministry of Law and Justice
Department of Legal Affairs
Legislative Department
Ministry of Home Affairs
Ministry of External Affairs
Ministry of Labour and Employment
Ministry of Commerce and Industry
Ministry of Electronics and Information Technology
Prime Minister's Office
Cabinet Secretariat
Law Commission of India
Comptroller and Auditor General of India
CAG
Attorney General of India
Solicitor General of India
Election Commission of India
Central Information Commission
National Human Rights Commission
State Bank of India
Punjab National Bank
Bank of Baroda
Union Bank of India
HDFC Bank
ICICI Bank
Axis Bank
Organisation for Economic Co-operation and Development
OECD
United Nations
International Monetary Fund
IMF
World Bank
Financial Action Task Force
FATF
Global Forum on Transparency and Exchange of Information
""".strip().split("\n")

AUTHORITIES = """
competent authority of India
competent authority of
Mutual Agreement Procedure
""".strip().split("\n")

# Label, name, priority, pattern.
PATTERNS = [
    ("SECTION_REF", "const_article", 1, r"Article\s+\d+(?:[A-Z]{1,2})?\s*(?:\(\d+\))?(?:\s*(?:of|read\s+with)\s+the\s+Constitution)?"),
    ("SECTION_REF", "clause_subsec_sec", 2, r"Clause\s+\([a-z]{1,3}\)\s+of\s+Sub-?[Ss]ection\s+\(\d+\)\s+of\s+[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "clause_sec", 3, r"Clause\s+\([a-z]{1,3}\)\s+of\s+[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "proviso_sec", 3, r"(?:first\s+|second\s+|third\s+)?[Pp]roviso\s+to\s+(?:Sub-?[Ss]ection\s+\(\d+\)\s+of\s+)?[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "explanation_sec", 3, r"[Ee]xplanation\s+\d*\s*to\s+(?:Sub-?[Ss]ection\s+\(\d+\)\s+of\s+)?[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "subsec_sec", 4, r"Sub-?[Ss]ection\s+\(\d+\)\s+of\s+[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "order_rule", 4, r"Order\s+[IVXivx]+\s+Rule\s+\d+(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "schedule", 4, r"(?:First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth|Eleventh|Twelfth|[IVX]+(?:th|st|nd|rd)?)\s+Schedule(?:\s+to\s+the\s+Act)?"),
    ("SECTION_REF", "sec_with_sub", 5, r"[Ss]ection\s+\d+(?:[A-Z]{1,2})?\s*(?:\(\s*[0-9a-zA-Z]+\s*\))+"),
    ("SECTION_REF", "sec_plain", 6, r"[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?![a-z])"),
    ("SECTION_REF", "rule_plain", 6, r"Rule\s+\d+(?:[A-Z]{1,2})?\s*(?:\([0-9a-zA-Z]+\))*"),
    ("SECTION_REF", "chapter", 7, r"Chapter\s+(?:[IVXivx]+|\d+)(?:-[A-Z])?"),
    ("SECTION_REF", "para", 7, r"para(?:graph)?\s+\d+(?:\([0-9a-zA-Z]+\))*"),
    ("NOTIFICATION", "so", 1, r"S\.O\.\s*\d+(?:\([A-Z]+\))?"),
    ("NOTIFICATION", "gsr", 1, r"G\.S\.R\.\s*\d+(?:\([A-Z]+\))?"),
    ("NOTIFICATION", "circular", 2, r"Circular\s+No\.?\s*\d+(?:/\d+)*(?:\s+of\s+\d{4})?"),
    ("NOTIFICATION", "instruction", 2, r"Instruction\s+No\.?\s*\d+(?:/\d+)*(?:\s+of\s+\d{4})?"),
    ("NOTIFICATION", "letter", 3, r"Letter\s+(?:F\.)?No\.?\s*[\w/()-]+(?:\s+dated)?"),
    ("NOTIFICATION", "fno", 2, r"F\.?\s*No\.?\s*[\d/\w().-]+"),
    ("NOTIFICATION", "press", 2, r"Press\s+Release\s+No\.?\s*[\d/]+"),
    ("NOTIFICATION", "notif_no", 2, r"Notification\s+No\.?\s*[\d/]+(?:\s*\([A-Z]+\))?(?:\s+dated\s+\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})?"),
    ("NOTIFICATION", "order_no", 3, r"Order\s+No\.?\s*[\d/\w().-]+"),
    ("NOTIFICATION", "cbdt_ref", 1, r"(?:CBDT|CBIC)\s+(?:Circular|Notification|Instruction)\s+No\.?\s*\d+(?:/\d+)*"),
    ("DATE", "fy", 1, r"F\.?Y\.?\s*\d{4}[-–]\d{2,4}"),
    ("DATE", "ay", 1, r"A\.?Y\.?\s*\d{4}[-–]\d{2,4}"),
    ("DATE", "wef", 1, r"w\.e\.f\.?\s+\d{1,2}[-./]\d{1,2}[-./]\d{2,4}"),
    ("DATE", "iso", 2, r"\d{4}-\d{2}-\d{2}"),
    ("DATE", "dd_mm_yyyy_dash", 2, r"\d{1,2}-\d{1,2}-\d{4}"),
    ("DATE", "dd_mm_yyyy_slash", 2, r"\d{1,2}/\d{1,2}/\d{4}"),
    ("DATE", "dd_mm_yyyy_dot", 2, r"\d{1,2}\.\d{1,2}\.\d{4}"),
    ("DATE", "dd_month_yyyy", 2, r"\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s*,?\s+\d{4}"),
    ("DATE", "month_dd_yyyy", 2, r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2}(?:st|nd|rd|th)?\s*,?\s+\d{4}"),
    ("DATE", "month_year", 3, r"(?:January|February|March|April|May|June|July|August|September|October|November|December),?\s+\d{4}"),
    ("MONEY", "inr_crore_lakh", 1, r"(?:Rs\.?|INR|₹)\s*[\d,]+(?:\.\d+)?\s*(?:Crore|Lakh|Arab|Thousand)?"),
    ("MONEY", "crore_lakh_words", 1, r"(?:Rs\.?|INR|₹)\s*[\d,]+(?:\.\d+)?\s*(?:crore|lakh|arab|thousand)"),
    ("MONEY", "numeral_crore", 1, r"\d+(?:\.\d+)?\s+(?:crore|Crore|lakh|Lakh)\s+rupees?"),
    ("MONEY", "usd", 2, r"USD\s*[\d,]+(?:\.\d+)?"),
    ("MONEY", "eur", 2, r"EUR\s*[\d,]+(?:\.\d+)?"),
    ("MONEY", "gbp", 2, r"GBP\s*[\d,]+(?:\.\d+)?"),
    ("MONEY", "rupee_sym", 2, r"₹\s*[\d,]+(?:\.\d+)?(?:\s*(?:crore|Crore|lakh|Lakh))?"),
    ("MONEY", "rs_plain", 3, r"Rs\.?\s*[\d,]+(?:\.\d+)?"),
]

#: Where the built-in set differs from PATTERNS: None leaves a rule out.
BUILTIN_CHANGES = {
    "letter": None,
    "crore_lakh_words": None,
    "rs_plain": None,
    "sec_plain": r"[Ss]ection\s+\d+(?:[A-Z]{1,2})?(?![a-z\d(])",
    "schedule": r"(?:First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth|Eleventh|Twelfth|[IVX]+)(?:th|st|nd|rd)?\s+Schedule(?:\s+to\s+the\s+Act)?",
    "notif_no": r"Notification\s+No\.?\s*[\d/]+(?:\s*\([A-Z]+\))?",
    "inr_crore_lakh": r"(?:Rs\.?|INR|₹)\s*[\d,]+(?:\.\d+)?\s*(?:[Cc]rore|[Ll]akh|[Aa]rab|[Tt]housand)?",
}
#: Statutes by structure: capitalised words, then a kind of statute and a year.
ACT_PATTERN = r"\b[A-Z][A-Za-z &(),-]{5,80}(?:Act|Code|Sanhita|Adhiniyam|Regulations?|Rules?),?\s+\d{4}\b"
#: Of spans of equal length the label with the smaller number wins.
LABEL_PRIORITY = {"NOTIFICATION": 0, "ACT_NAME": 1, "SECTION_REF": 2, "ORG": 3, "DATE": 4, "MONEY": 5}
