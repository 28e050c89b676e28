"""Fixed values of the support-message domain.

Everything here is data, not logic: class names, rule phrases, thresholds and
text formats whose exact spelling decides results.  Every operator takes them
as defaults of parameters, so another domain passes its own lists.
"""

SEED = 42

# The intent classes.
INTENTS = [
    "apple_id_login",
    "icloud_sync",
    "app_store",
    "battery_issue",
    "charging_issue",
    "software_update",
    "device_setup",
    "billing_refund",
    "account_security",
]

# Intent rules in priority order.  Each phrase is a regular
# expression fragment; a rule matches when one of them occurs as whole words.
INTENT_RULES = [
    ("account_security", r"hack|hacked|unauthorized|compromised|breach|phish|phishing|stolen account|security alert|suspicious activity|lockout|locked account|someone logged into|stolen device|stolen phone|lost iphone|stolen iphone|scam|scammed|privacy alert|activation lock|lost mode|fraud"),
    ("apple_id_login", r"apple id|appleid|sign in|signed out|login|log in|two factor|2fa|verification code|reset password|passcode|forgot password|credentials|cant log in|can't sign in|forgot my password"),
    ("billing_refund", r"refund|refunds|billing|overcharged|overcharge|subscription|subscriptions|invoice|invoices|payment|receipt|itunes charge|bank statement|deducted|charged me|charged twice|charged for|cancel subscription|monthly fee|credit card|apple pay charge|purchase receipt|billed me|money back"),
    ("charging_issue", r"charging|charger|lightning cable|magsafe|not charging|slow charge|charging port|cable broken|plugged in|wall charger|usb-c cable|charge cable|won't charge|wont charge|stops charging|wont take a charge|charger wire|adapter"),
    ("battery_issue", r"battery|battery drain|draining|battery life|percentage drops|overheating|hot phone|battery health|dies quickly|shut down at 20%|dies fast|battery percentage|low power mode|drains so fast"),
    ("icloud_sync", r"icloud|storage full|sync|syncing|photos sync|cloud backup|icloud drive|icloud storage|restore from icloud|not backing up|icloud photo|icloud space|backup failed"),
    ("app_store", r"app store|appstore|download app|app crash|apps crashing|app not loading|install app|testflight|downloading app|update app|in-app purchase|can't download app|store download"),
    ("device_setup", r"setup|set up|new iphone|new ipad|transfer data|quick start|activation|activate|restore backup|unboxing|migration|pair|pairing|bluetooth|carplay|airpods|pair watch|apple watch setup"),
    ("software_update", r"ios \d+|ios update|upgrade to ios|software update|ipados|macos|watchos|stuck on apple logo|update failed|bricked|software glitch|os bug|boot loop|freeze|freezing|touch screen lag|keyboard glitch|update|upgrade"),
]

# Routing lists and thresholds.
RISKY_INTENTS = ["account_security", "billing_refund"]
RISKY_KEYWORDS = [
    "lost", "stolen", "fraud", "unauthorized", "hacked", "compromised", "scam", "bank", "chargeback",
    "lawsuit", "lawyer", "stole", "breach", "phishing",
    "stolen phone", "stolen ipad", "stolen macbook", "stolen watch",
]
BASELINE_KEYWORDS = ["hack", "stolen", "fraud", "unauthorized", "lost"]
AUTO_CONFIDENCE = 0.85
ESCALATE_CONFIDENCE = 0.60
LABEL_CONFIDENCE = 0.90

# Sizes.
EMBEDDING_DIM = 384
TOP_K = 5
MAX_REPLY_WORDS = 70
MIN_CHARS = 20
GOLDEN_MIN_CHARS = 25
ASCII_SHARE = 0.85
SPLITS = ("train", "validation", "test")
SPLIT_FRACTIONS = (0.6, 0.2, 0.2)
SPLIT_CLASS_CAPS = (900, 225, 225)
SPLIT_TOTALS = (8000, 2000, 2000)
GOLDEN_PER_CLASS = 23
GOLDEN_TOTAL = 200
FRESH_TOTAL = 2000
REVIEW_TOTAL = 30

# Texts and text formats.
BRAND = "AppleSupport"
TEXT_COLUMNS = ("tweet", "text", "customer_message", "query", "message")
NO_CONTEXT = "No historical examples found."
NO_EXAMPLES = "No specific reference examples available."
DEFAULT_REPLY = (
    "We're here to help. Please restart your device, check Settings for available updates, "
    "and let us know if the issue persists."
)
RUBRIC = ("correctness", "helpfulness", "brand_tone", "groundedness")
HELPFUL_TOKENS = ["settings", "apple", "support", "restart", "update", "dm", "icloud", "id"]
TONE_TOKENS = ["help", "dm", "please"]
REPLY_PROMPT = (
    'Predicted Intent: {intent}\n\nCustomer Message:\n"{tweet}"\n\n'
    "Historical Apple Support Reference Examples (Grounded Context):\n{context}\n\n"
    "Draft an official Apple Support reply for the customer message that addresses their issue "
    "directly based on the reference context."
)
JUDGE_PROMPT = (
    'Customer Tweet:\n"{tweet}"\n\nIntent: {intent}\n\nGolden Reference Reply:\n"{gold_reply}"\n\n'
    'Generated Reply to Evaluate:\n"{generated_reply}"\n'
)
HEURISTIC_EXPLANATION = "Heuristic fallback evaluation based on keyword grounding and length constraints."
JUDGE_SKIPPED = "Skipped. Run with `--judge` to trigger LLM-as-a-judge."
