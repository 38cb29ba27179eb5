"""Shipped banking rules. They decide which calls and sentences are kept.

Every operator takes its rules as a parameter; these are the defaults. Phrases are plain words for
the whole-word test; patterns use the usual regex notation and go through ``text.portable``.
"""

from __future__ import annotations

# --- fixed values: domain words -----------------------------------------------------------------

DEV_KEYWORDS = (
    "bank", "banking", "account", "balance", "statement", "transfer", "wire", "zelle", "ach",
    "routing", "checking", "savings", "deposit", "overdraft", "card", "credit", "debit",
    "chargeback", "fraud", "dispute", "pin", "atm", "mortgage", "loan", "password", "passcode",
    "online banking",
)

BUILD_KEYWORDS = DEV_KEYWORDS + (
    "payment", "autopay", "direct deposit", "interest", "fee", "late fee", "billing",
)

METADATA_WORDS = ("bank", "finance", "credit")

REFINE_POSITIVE = (
    "bank", "banking", "debit", "credit", "card", "chargeback", "dispute", "fraud", "balance",
    "statement", "account", "checking", "savings", "routing", "wire", "zelle", "ach", "overdraft",
    "atm", "pin", "mortgage", "loan", "direct deposit", "autopay", "interest", "fee", "late fee",
    "bill pay", "password", "passcode", "online banking", "mobile banking",
)

REFINE_NEGATIVE = (
    "router", "modem", "internet", "cable", "tv service", "technician", "installation", "outage",
    "wifi", "wi-fi", "bandwidth", "plumbing", "hvac", "gas line", "appliance", "water heater",
    "faucet", "drain", "leak", "maintenance", "electricity", "utility",
)

FIRST_PERSON = (
    "i", "i'm", "i’ve", "i’d", "i’ll", "my", "me", "mine", "can’t",
    "couldn’t", "don’t", "won’t",
)

BANK_TERMS = (
    "account", "balance", "statement", "card", "credit", "debit", "charge", "dispute", "fraud",
    "pin", "atm", "transfer", "wire", "ach", "zelle", "routing", "checking", "savings",
    "overdraft", "fee", "interest", "loan", "mortgage", "password", "login", "online banking",
    "mobile app", "bill pay", "direct deposit",
)

CONFIG_KEYWORDS = (
    "bank", "banking", "credit card", "debit card", "account", "balance", "statement", "transfer",
    "wire", "loan", "mortgage", "direct deposit", "overdraft", "dispute", "fraud", "chargeback",
    "ATM", "PIN", "password reset", "Zelle", "ACH",
)

BUCKET_LABEL = "Medicare_inbound (USA- USA)"

# --- fixed values: speakers ---------------------------------------------------------------------

CUSTOMER_ALIASES = (
    "customer", "user", "caller", "client", "member", "patient", "subscriber", "consumer", "guest",
)
AGENT_ALIASES = (
    "agent", "rep", "representative", "csr", "advisor", "associate", "operator", "support",
    "specialist", "staff",
)

PREFIX_ROLES = (
    "agent", "rep", "representative", "advisor", "associate", "operator", "support", "specialist",
    "staff", "csr", "customer", "user", "caller", "client", "member",
)
PREFIX_CUSTOMER_ROLES = ("customer", "user", "caller", "client", "member")

# --- fixed values: intent rules (ordered where the first match wins) ------------------------------

SUGGEST_RULES = (
    (r"lost|stolen.*card|freeze|lock", "card_lost_or_stolen"),
    (r"charge|dispute|fraud|unauthor", "card_charge_dispute_or_fraud"),
    (r"balance|available|limit", "balance_or_credit_limit"),
    (r"statement|document|monthly", "request_statement_or_document"),
    (r"transfer|wire|ach|zelle", "money_transfer_wire_ach_zelle"),
    (r"password|login|reset|locked", "online_banking_login_reset"),
    (r"overdraft|fee|charge", "fees_or_overdraft"),
    (r"mortgage|loan|interest|refinance", "loan_or_mortgage_info"),
    (r"open.*account|new account", "open_new_account"),
    (r"close.*account", "close_account"),
    (r"pin|atm", "card_pin_or_atm_issue"),
    (r"direct deposit|payroll", "direct_deposit_setup_or_issue"),
    (r"bill pay|autopay|payment", "bill_pay_or_autopay_issue"),
    (r"address|update.*info|change.*phone", "profile_or_contact_update"),
)

SEED_RULES = (
    ("card_lost_or_stolen", r"\b(lost|stolen)\s+card|\bfreeze\b|\block\b"),
    ("card_charge_dispute_or_fraud", r"\b(dispute|chargeback|unauthori[sz]ed|fraud)\b"),
    ("balance_or_credit_limit", r"\b(balance|available balance|credit limit)\b"),
    ("request_statement_or_document", r"\b(statement|monthly statement|pdf|document)\b"),
    ("money_transfer_wire_ach_zelle", r"\b(wire|ach|zelle|transfer)\b"),
    ("online_banking_login_reset", r"\b(password|passcode|login|locked|reset)\b"),
    ("fees_or_overdraft", r"\b(fee|overdraft|nsf)\b"),
    ("loan_or_mortgage_info", r"\b(loan|mortgage|refinance|rate)\b"),
    ("open_new_account", r"\b(open|new)\s+(account)\b"),
    ("close_account", r"\b(close|closing)\s+(account)\b"),
    ("card_pin_or_atm_issue", r"\b(pin|atm)\b"),
    ("direct_deposit_setup_or_issue", r"\b(direct deposit|payroll)\b"),
    ("bill_pay_or_autopay_issue", r"\b(bill\s?pay|autopay|auto pay|payment)\b"),
)

STRICT_RULES = (
    (
        "card_lost_or_stolen",
        r"\b(lost|stolen|freeze|locked|lock|block)\b.*\b(card)\b"
        r"|\b(card)\b.*\b(lost|stolen|freeze|locked|lock|block)\b",
    ),
    ("card_charge_dispute_or_fraud", r"\b(dispute|charge ?back|unauthori[sz]ed|fraud)\b"),
    (
        "balance_or_credit_limit",
        r"\b(balance|available\s+balance|credit\s+limit|limit\s+increase)\b",
    ),
    (
        "request_statement_or_document",
        r"\b(statement|monthly\s+statement|pdf|document|download|mail\s+(me|it))\b",
    ),
    ("money_transfer_wire_ach_zelle", r"\b(wire|ach|zelle|transfer|send\s+money)\b"),
    (
        "online_banking_login_reset",
        r"\b(password|passcode|login|log[\s-]?in|locked|reset|unlock)\b",
    ),
    (
        "fees_or_overdraft",
        r"\b(fee|overdraft|nsf|insufficient\s+funds|maintenance\s+fee|charge\s+fee)\b",
    ),
    (
        "loan_or_mortgage_info",
        r"\b(loan|mortgage|refinance|refi|rate|interest\s+rate|apr|pre[-\s]?approval)\b",
    ),
    ("open_new_account", r"\b(open|opening)\s+(a\s+)?(checking|savings|account)\b"),
    ("close_account", r"\b(close|closing|terminate|cancel)\s+(the\s+)?(account)\b"),
    ("card_pin_or_atm_issue", r"\b(pin|atm|cash\s+machine|withdraw(al)?)\b"),
    ("direct_deposit_setup_or_issue", r"\b(direct\s+deposit|payroll|routing\s+number)\b"),
    (
        "bill_pay_or_autopay_issue",
        r"\b(bill\s*pay|auto\s*pay|autopay|payment|pay\s+bill|schedule\s+payment)\b",
    ),
)

TOPUP_RULES = (
    (
        "billing_zip_verification",
        r"\b(billing\s+zip|postal\s+code|zip\s+code\s+(?:on|for)\s+(?:the\s+)?card"
        r"|verify\s+(?:my\s+)?zip)\b",
    ),
    (
        "branch_or_service_coverage_by_location",
        r"\b(branch(?:es)?|bank\s+near\s+me|open\s+hours|hours\s+today"
        r"|do\s+you\s+service\s+(?:my\s+)?area|licensed\s+in\s+\{location\}"
        r"|in\s+\{location\}\b)",
    ),
    (
        "profile_or_contact_update",
        r"\b(update|change|edit)\s+(?:my\s+)?(address|email|phone|contact\s+info)\b"
        r"|\bhow\s+do\s+i\s+update\b",
    ),
    (
        "direct_deposit_setup_or_issue",
        r"\b(direct\s+deposit|payroll\s+deposit|routing\s+number|account\s+number\s+for\s+deposit"
        r"|set\s+up\s+direct\s+deposit)\b",
    ),
)

TOPUP_TARGETS = {
    "billing_zip_verification": 50,
    "branch_or_service_coverage_by_location": 50,
    "profile_or_contact_update": 50,
    "direct_deposit_setup_or_issue": 50,
}

AGENT_OPENINGS = ("i'll ", "let me ", "i can ", "we can ")

ANSWERABLE_INTENTS = (
    "balance_or_credit_limit",
    "bill_pay_or_autopay_issue",
    "billing_zip_verification",
    "branch_or_service_coverage_by_location",
    "card_charge_dispute_or_fraud",
    "card_pin_or_atm_issue",
    "direct_deposit_setup_or_issue",
    "fees_or_overdraft",
    "loan_or_mortgage_info",
    "money_transfer_wire_ach_zelle",
    "online_banking_login_reset",
    "profile_or_contact_update",
    "request_statement_or_document",
)

MIN_PER_INTENT = 50
MAX_PER_INTENT = 150
QUESTION_SHARE = 0.3

# --- fixed values: stop words -------------------------------------------------------------------

# Spark ML's default English list, so that no JVM call is needed to build an expression.
ENGLISH_STOPS = tuple(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom this
    that these those am is are was were be been being have has had having do does did doing a an
    the and but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
    they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
    wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would""".split()
)
FILLER_STOPS = ("uh", "um", "yeah", "yes", "okay", "ok", "right", "thank", "thanks")
DISCOVERY_STOPS = ENGLISH_STOPS + FILLER_STOPS
