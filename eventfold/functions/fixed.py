"""Word lists and patterns that must be these for the results to be the same. Plain text, in natural order."""

JUNK_TITLES = (
    "today", "more info", "upcoming events", "register", "register now", "events", "learn more", "learn more.", "google calendar",
    "conferences", "read more", "read more »", "login with facebook", "yourmembership", "view event", "home", "calendar", "view calendar",
    "view all events", "see all events", "details", "click here", "subscribe", "download", "sign in", "log in", "view program description",
    "learn more and secure your room at special rates.", "past events", "events calendar", "contact us", "quick links", "announcements",
    "empty heading", "no title", "untitled", "masterclasses", "masterclass", "lunchtime series", "listing", "theme", "webinar", "webinars",
    "conference", "seminar", "seminars", "news letter", "newsletter", "training", "workshop", "workshops", "programme", "program", "session",
    "sessions", "meeting", "meetings", "series", "resilience", "economic education",
)
JUNK_SUBSTRINGS = ("check eligibility", "login with", "secure your room at special rates")
GENERIC_HEADINGS = (
    "masterclasses", "masterclass", "lunchtime series", "listing", "theme", "webinar", "webinars", "conference", "conferences", "seminar",
    "seminars", "news letter", "newsletter", "event", "events", "details", "register", "training", "workshop", "workshops", "programme",
    "program", "session", "sessions", "meeting", "meetings", "series", "resilience", "economic education", "update", "updates",
)
LISTING_TITLE = (
    r"^(upcoming\s+|all\s+)?(events?|conferences?|seminars?|webinars?)(\s*(&|and)\s*\w+)?(\s+(calendar|archive|list|listing|display|directory))?$"
    r"|^event\s+display$|^events?\s+-\s+|^(event|full|more|view)\s+details?$|^(learn|read|see|find out)\s+more$|^book\s+now$"
)
NAV_TITLE = (
    r"^(become an?\s+(event\s+)?(sponsor|member|partner)|save by becoming.{0,30}|partner with us|sponsor(ship)?\b.{0,30}|advertise with us"
    r"|contact us|about us|our (team|partners|sponsors)|membership|join (us|now|today)|(\w[\w'&-]*\s+){0,3}events)$"
)
RELEVANCE_KEYWORDS = (
    "tax", "finance", "financial", "legal", "law", "accounting", "audit", "bank", "securities", "insurance", "compliance", "insolvency",
    "actuari", "corporate governance", "cpa", "estate planning", "wealth management",
)
BLOCKED = "blocked by the site"
BLOCK_LENGTH = 3000
BLOCK_MARKERS = ("403 forbidden", "access denied", "unexpected error", "are you a human", "attention required", "just a moment")
MORE_PAGES = (
    r"rel=[\"']next[\"']|load\s+more|show\s+more|view\s+more|more\s+events|older\s+events|next\s+page|[?&]e?page=\d|/page/\d"
    r"|class=[\"'][^\"']*pagination|aria-label=[\"']pagination|infinite[-_ ]scroll"
)
LISTING_DATE = r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\.?\s+\d{1,2}\b|\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"
EVENTS_LINK = (
    r"^(upcoming\s+)?events?$|^events?\s*&\s*programs?$|^programs?\s*&\s*events?$|^calendar(\s+of\s+events)?$|^events?\s+calendar$"
)

US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
    "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
    "DC",
)
COUNTRY_WORDS = {
    "USA": ("usa", "united states"),
    "UK": ("united kingdom", "uk", "london"),
    "India": ("india", "mumbai", "delhi", "bengaluru", "bangalore", "kolkata", "chennai", "hyderabad", "pune"),
    "UAE": ("dubai", "abu dhabi", "uae", "united arab emirates"),
    "AUS": ("australia", "sydney", "melbourne", "brisbane", "perth"),
    "SG": ("singapore",),
}
UNTRACKED_PLACES = (
    "china", "beijing", "shanghai", "hong kong", "japan", "tokyo", "osaka", "canada", "toronto", "calgary", "germany", "france", "paris",
    "switzerland", "geneva", "zurich", "ireland", "new zealand", "south africa",
)

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
    "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sept", "Sep", "Oct", "Nov", "Dec",
)
FULL_NUMERIC_DATE = r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}"
DAY_NUMBER = r"\b\d{1,2}(?:st|nd|rd|th)?\b"
EXPLICIT_YEAR = r"\b(?:19|20)\d{2}\b"
HELD_IN_YEAR = (
    r"(?:was held|held (?:on|from|in)|took place|was conducted|conducted (?:on|in)|concluded on|was organi[sz]ed|was convened).{0,60}?(\d{4})\b"
)
ANY_YEAR = r"\b(1[89]\d{2}|20\d{2})\b"

REJECT_PATTERNS = {
    "social event": r"\b(happy hour|mixer|golf|holiday party|christmas party|reception|social hour|cocktail|gala|networking (lunch|drinks|breakfast|evening)"
    r"|yoga|wellness|fun run|5k|dinner|sundowner|trivia night|quiz night)\b",
    "exam prep": r"\b(exam (review|prep|preparation|training|bootcamp)|pre[- ]exam|pass (the|your) .{0,20}exam|examiner (school|training)|mock exam"
    r"|exam registration|exam enrol+ment|study skills)\b",
    "corporate notice": r"\b(annual general meeting|\bagm\b|dividend (declaration|announcement|payment|record)|board meeting|intimation|record date"
    r"|results? announcement|postal ballot)\b",
    "newsletter/publication": r"\b(newsletter|quarterly issue|journal issue|magazine issue|e-?bulletin)\b",
    "college event": r"\b(alumni|campus recruit|college (event|fair)|actec)\b",
}
CATEGORY_ORDER = ("Tax", "Legal", "Finance")
GENERIC_WORD = "generic word"
NO_TOPIC = "no Tax, Finance or Legal topic found in the event's title or description"
ONLY_GENERIC = "only a generic word or a single passing mention ("
NOT_ENOUGH = ") -- not enough to accept on rules alone"
IN_THE_TEXT = "' in the event text"
IN_OWN_TEXT = " topic in the event's own text: "
ALSO_MATCHES = " (also matches "
BY_ORDER = " chosen by fixed order)"

FINAL_COLUMNS = ("Date", "End Date", "Status", "Event Name", "Organizer", "Category", "Format", "Location", "Description", "Register Link", "Source URL")
UPDATABLE = ("country", "date", "end_date", "event_name", "category", "format", "location", "description", "register_link")
HEADER_ALIASES = {
    "organizer": ("organization", "organisation", "org", "name"),
    "category": ("category", "focus"),
    "country": ("country",),
    "url": ("events page", "event page", "url", "link", "official event / calendar"),
}
MISSING_INFO = (
    r"cookie|privacy|consent|no information|does not (contain|provide|state|include)|not provide|missing|empty|unreadable|generic template"
    r"|only (the )?(name|title|navigation)"
)

# Labels and marks within pages.
LABEL_LINE = r"\s*([A-Za-z][A-Za-z &/]{1,30}?)\s*[:：]\s*(\S.{0,250})$"
ABOUT_A_DATE = r"date|deadline|by|until|clos"
SITE_NAME_AFTER = r"\s+[|\-–—]\s+"
LEAST_TITLE, LEAST_PARAGRAPH = 8, 60
MODE_TAG = r"(hybrid|virtual|online|in[\s-]?person)( event)?|(live )?webinar"
CARD_MODE_LABEL = r"(event\s+)?(mode|format|attendance)"
NO_PAGE_LINKS = ("#", "javascript:", "mailto:", "tel:")
BLOCKS = ("h1", "h2", "h3", "h4", "p", "li", "td", "th", "dt", "dd", "div", "section", "article")

# What the log and the checks say.
LEGACY = "Legacy (before v2)"
NOT_FOUND_SINCE = "Not found on its website since "
DATE_PASSED, NOT_ON_SITE, BY_RUN = "date passed", "not on website", "Scraper"
ACTIONS = {
    "added": "added",
    "promoted": "promoted to Verified",
    "legacy_replaced": "legacy row upgraded to verified",
    "sent_to_review": "sent to Needs Review",
    "rejected": "rejected",
    "past": "moved to Past Events",
    "missing": "sent to Needs Review",
}
MESSAGES = {
    "no_title": "no event title",
    "generic_title": "title '{value}' is a generic label, not an event name",
    "weak_title": "title only came from a {source} ({confidence} confidence)",
    "unproved": "{column} '{value}' could not be found on the event page",
    "no_date": "no event date",
    "bad_date": "date '{value}' is not a real date",
    "past_date": "event date {value} has already passed",
    "far_date": "event date {value} is implausibly far ahead",
    "weak_date": "date only came from a {source} ({confidence} confidence)",
    "title_date": "the date in the title disagrees with the event date",
    "untracked": "location '{value}' is in a country we don't track",
    "category": "the rules could not place it in Tax, Finance or Legal (goes to the AI review, not rejected)",
}

# How far the surroundings of a date may reach.
CLIMB, MOST_LINKS, MOST_HEADINGS = 5, 3, 2

#: The words of a format; the first that a text has decides.
MODE_WORDS = {
    "Hybrid": r"hybrid",
    "Virtual": r"\b(online|virtual|webinar|zoom|teams|webex|livestream)\b",
    "In Person": r"\b(in[\s-]?person|physical|on[\s-]?site|offline)\b",
}
#: The same for what a card or a page shows as running text.
TEXT_MODE_WORDS = {"Virtual": r"\b(virtual|online|webinar|zoom|livestream|web conference)\b", "In Person": r"\b(in[\s-]?person|on[\s-]?site)\b"}
#: The last part of schema.org's attendance modes.
ATTENDANCE_MODES = {"mixed": "Hybrid", "online": "Virtual", "offline": "In Person"}
PLACE_IN_TEXT = r"\b[A-Z][a-zA-Z.]+(?:\s[A-Z][a-zA-Z.]+)*,\s*[A-Z]{2}\b"

_MONTH = "(?:" + "|".join(MONTH_NAMES) + ")"
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
FULL_DATE_IN_TEXT = rf"(?:{_DAY}\s*(?:[-–—]|to)\s*)?{_DAY}\s+{_MONTH}\.?,?\s+20\d\d|{_MONTH}\.?\s+{_DAY}(?:\s*[-–—]\s*{_DAY})?,?\s+20\d\d|20\d\d-\d\d-\d\d"
CARD_DATES = (
    rf"(?i)\b{_MONTH}\.?\s+\d{{1,2}}(?:\s*[-–—]\s*(?:{_MONTH}\.?\s+)?\d{{1,2}})?(?:,?\s*\d{{4}})?\b",
    r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
    rf"(?i)\b\d{{1,2}}\s+{_MONTH}\.?(?:,?\s*\d{{4}})?\b",
)
BEFORE_A_DATE = 24
LEAST_CARD, MOST_CARD, MOST_SIBLINGS, LEAST_RATE, LONGEST_TAG = 15, 5000, 300, 0.3, 20
