"""Vocabularies and limits that the operators take as defaults; every operator lets you pass your own."""

from __future__ import annotations

# Class labels.
TARGET_CLASSES = ("dealer", "dealer_group")
MIN_WRITE_CONFIDENCE = 0.8

# Cooldown hours after (attempts up to, hours); more attempts take the last.
COOLDOWNS = ((1, 6), (3, 24))
LAST_COOLDOWN = 72

# Contact statuses that keep a contact out of an audience.
EXCLUDED_STATUSES = ("inactive", "suppressed", "invalid")

# Brand words in the order in which they are tried, and how a brand is written.
BRANDS = {
    "acura": "Acura", "audi": "Audi", "bmw": "BMW", "buick": "Buick", "cadillac": "Cadillac",
    "chevrolet": "Chevrolet", "chevy": "Chevrolet", "chrysler": "Chrysler", "dodge": "Dodge", "ford": "Ford",
    "gmc": "GMC", "honda": "Honda", "hyundai": "Hyundai", "infiniti": "Infiniti", "jeep": "Jeep",
    "kia": "Kia", "lexus": "Lexus", "lincoln": "Lincoln", "mazda": "Mazda", "mercedes": "Mercedes-Benz",
    "mercedes-benz": "Mercedes-Benz", "mini": "MINI", "mitsubishi": "Mitsubishi", "nissan": "Nissan",
    "porsche": "Porsche", "ram": "Ram", "subaru": "Subaru", "toyota": "Toyota", "volkswagen": "Volkswagen",
    "vw": "Volkswagen", "volvo": "Volvo",
}
# Brand words in evidence text, and brands that domains of shops end in.
BRAND_WORDS = (
    "acura", "audi", "bmw", "buick", "cadillac", "chevrolet", "chevy", "chrysler", "dodge", "ford", "gmc",
    "honda", "hyundai", "infiniti", "jeep", "kia", "lexus", "lincoln", "mazda", "mercedes", "mini",
    "mitsubishi", "nissan", "porsche", "ram", "subaru", "toyota", "volkswagen", "volvo",
)
ALIAS_BRANDS = (
    "acura", "audi", "bmw", "buick", "cadillac", "chevrolet", "chevy", "chrysler", "dodge", "ford", "gmc",
    "honda", "hyundai", "jeep", "kia", "lexus", "lincoln", "mazda", "nissan", "porsche", "ram", "subaru",
    "toyota", "volkswagen", "vw",
)

# State codes.
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
)

# Pattern families over evidence text.
VENDOR_PATTERNS = (
    r"\bcox automotive\b", r"\breynolds (?:and|&) reynolds\b", r"\bdealertrack\b", r"\bautomotive software\b",
    r"\bdealer crm\b", r"\bautomotive retail technology\b", r"\btitle and registration processing\b",
    r"\bdealership title\b", r"\btitle clerk education\b", r"\bnationwide auto dealership\b", r"\bcdp\b",
    r"\blead platform\b", r"\bintent-based marketing\b", r"\bautomotive systems and components manufacturer\b",
    r"\bcomponents manufacturers?\b", r"\bdigital marketing\b", r"\binternet marketing agency\b",
    r"\bauction(s)?\b", r"\bwholesale auction\b", r"\bdealer marketing\b", r"\bdealer services\b",
    r"\bautomotive customer data\b", r"\bautomotive audience\b", r"\bautomotive data platform\b",
    r"\bdealer solutions\b", r"\bf&i selling system\b", r"\bfinance and insurance\b", r"\baged inventory\b",
    r"\bmobility data\b", r"\bdata and analytics company\b", r"\bmarketing platform\b", r"\btelematics\b",
    r"\btrucking industry\b", r"\btrailer needs\b", r"\bheavy-haul distributor\b", r"\btruck bodies\b",
)
NON_DEALER_PATTERNS = (
    r"\bhome care\b", r"\bhealth care\b", r"\bmedical\b", r"\bclinic\b", r"\bdental\b", r"\bcharity cars\b",
    r"\bvehicle donation\b", r"\blaw firm\b", r"\binsurance agency\b", r"\bmarketing agency\b",
    r"\bconsulting services\b", r"\bstrategy\b", r"\badvisory\b", r"\bmanaged services\b", r"\bconstruction\b",
    r"\broofing\b", r"\buniversity\b", r"\bstaffing\b", r"\belectricity\b", r"\bpower company\b",
    r"\baviation\b", r"\baircraft\b", r"\bit services\b", r"\bcyber security\b",
    r"\bmicrosoft certified solutions partner\b", r"\berp\b", r"\bcloud\b", r"\bofficial website\b",
    r"\bmoving beyond smoking\b", r"\bsmoking\b", r"\btobacco\b", r"\bforest products\b", r"\bgravel mining\b",
    r"\btree farm\b", r"\bhardware\b", r"\bdesign studio\b", r"\bgraphic design\b", r"\bui/ux\b",
)
INDUSTRY_PATTERNS = (
    r"\bautomotive accessories\b", r"\bvehicle wraps\b", r"\bwindow tint(?:ing)?\b", r"\bpaint protection\b",
    r"\bceramic coatings\b", r"\blift kits\b", r"\bleveling kits\b", r"\bbed covers\b", r"\bcamper shells\b",
    r"\boffroad\b", r"\bstyle & performance\b", r"\bdetailing\b", r"\bwheel(?:s)? and tire(?:s)?\b",
    r"\bsuspension\b", r"\bautomotive services\b", r"\bautomotive styling\b", r"\bupfitting\b",
    r"\btrailer hitches\b",
)
GROUP_PATTERNS = (r"\bauto group\b", r"\bautomotive group\b", r"\bdealer group\b", r"\bautoplex\b", r"\bmotors group\b")
DEALER_PATTERNS = (
    r"\bnew inventory\b", r"\bused inventory\b", r"\bschedule test drive\b", r"\bvalue my trade\b",
    r"\bservice department\b", r"\bcertified pre-owned\b", r"\bparts department\b", r"\bfinance department\b",
    r"\bshop new\b", r"\bshop used\b", r"\bnew vehicles\b", r"\bused vehicles\b", r"\btrade-in\b",
    r"\bapply for financing\b", r"\bschedule service\b", r"\boil change\b", r"\bcar dealership\b",
    r"\bauto dealership\b", r"\bbuy your next vehicle\b",
)
OEM_PATTERNS = (r"\bford motor company\b", r"\btoyota motor\b", r"\bgeneral motors\b", r"\bhonda motor\b", r"\bnissan motor\b")
CONTEXT_PATTERNS = (
    r"\bauto\b", r"\bautos\b", r"\bautomotive\b", r"\bdealer\b", r"\bdealership\b", r"\bvehicle\b",
    r"\bvehicles\b", r"\bcar\b", r"\bcars\b", r"\btruck\b", r"\btrucks\b", r"\bsuv\b", r"\bsuvs\b", r"\bvan\b",
    r"\bvans\b", r"\bpickup\b", r"\bpre-owned\b", r"\bcertified pre-owned\b",
)

# Hosts.
VENDOR_HOSTS = (
    "activator.ai", "mazdaleads.com", "affinitiv.com", "acvauctions.com", "adesa.com", "askpatty.com",
    "autotrader.com", "autonation.com", "dealer.com", "dealerspace.com", "cmdlr.com",
)
OEM_ROOT_HOSTS = ("audi.com", "ford.com", "toyota.com", "honda.com", "chevrolet.com", "nissanusa.com")
OEM_SUFFIXES = (".ford.com", ".toyota.com", ".honda.com", ".chevrolet.com", ".nissanusa.com")
OEM_SITES = ("hondaweb.com",)
VENDOR_HOST_WORDS = ("software", "consulting", "agency", "vendor", "crm", "marketing")
CARE_HOST_WORDS = ("care", "health", "clinic", "hospital", "dental", "medical")

# Words of the remaining rules.
INDEPENDENT_WORDS = ("auto", "autos", "autoland", "automall", "autoplex", "motors", "cars", "autosales", "sales", "used")
DOMAIN_WORDS = ("sales", "autoplex", "motors", "autos", "auto", "cars")
ROOFTOP_ALIASES = ("benz", "gm", "vw")
SHOPPING_WORDS = ("inventory", "service", "finance", "test drive", "trade")
TITLE_WORDS = ("dmv", "title processing", "registration processing")
SPECIALTY_WORDS = ("accessories", "tint", "wraps", "detailing", "offroad", "suspension", "wheels and tires")
INVENTORY_HINTS = ("inventory", "new-inventory", "used-inventory", "vehicle-details", "new vehicles", "used vehicles", "cars-for-sale", "certified", "pre-owned")
INVENTORY_PATHS = ("/new-inventory/index.htm", "/used-inventory/index.htm", "/inventory/index.htm", "/new-inventory", "/used-inventory", "/cars-for-sale", "/search/", "/search")
NOT_VEHICLE_WORDS = ("news", "paint", "hardware", "portfolio", "design", "marketing", "credit", "supplies", "blog", "press-release")
VEHICLE_WORDS = ("inventory", "vehicle", "cars-for-sale", "pre-owned", "certified", "new-inventory", "used-inventory")

# Pages with people and places, markers of refused pages.
CONTACT_PATHS = (
    "/staff", "/staff.aspx", "/staff.html", "/meet-our-staff", "/meet-our-staff.aspx", "/our-team", "/team",
    "/leadership", "/leadership.aspx", "/about-us", "/aboutus.aspx", "/contact-us", "/contactus.aspx", "/sales",
    "/service",
)
SITE_PATHS = ("/", "/about-us", "/contact-us", "/staff", "/meet-our-staff", "/our-team", "/leadership")
PEOPLE_WORDS = ("staff", "team", "leadership", "about", "contact", "finance", "service", "sales", "manager")
PAGE_PRIORITIES = (("staff", "team"), ("leadership", "manager"), ("about", "contact"), ("sales", "service", "finance"))
BLOCK_MARKERS = (
    "access denied", "attention required! | cloudflare", "just a moment...",
    "enable javascript and cookies to continue", "site currently not available", "page unavailable",
    "sorry, we're under maintenance", "access error | autonation", "captcha-delivery.com",
    "please enable js and disable any ad blocker", "cf-wrapper", "errors.edgesuite.net",
)
RENDERED_MARKERS = ("access denied", "attention required! | cloudflare", "just a moment...", "enable javascript and cookies to continue", "captcha", "cf-browser-verification")
ERROR_REASONS = (("err_connection_refused", "browser_connection_refused"), ("err_name_not_resolved", "browser_dns_error"), ("net::err_", "browser_network_error"))
OTHER_ERROR = "browser_navigation_error"

# Roles as (type, family, titles), first match wins.
ROLES = (
    ("general_manager", "executive", r"general manager|gm"),
    ("dealer_principal", "executive", r"co-owner|dealer principal|principal|owner|managing partner|partner"),
    ("president", "executive", r"president|ceo|chief executive officer"),
    ("operations", "operations", r"coo|chief operating officer|operations manager|operations director|director of operations|fixed operations director|fixed ops director"),
    ("sales", "sales", r"general sales manager|internet sales manager|sales manager|sales director|director of sales|new car manager|used car manager"),
    ("service", "service", r"service manager|service director|fixed ops manager|parts manager|parts director"),
    ("marketing", "marketing", r"marketing manager|marketing director|digital marketing|e-?commerce director"),
    ("finance", "executive", r"cfo|chief financial officer|controller|finance director|business manager|finance manager"),
)
TITLE_LIKE_WORDS = ("manager", "director", "service", "sales", "operations", "marketing", "executive", "principal")
NAME_ENDINGS = ("Co", "General", "Internet", "Business", "New", "Used", "Service", "Parts", "Finance")
NAME_TAILS = ("Home", "Homepage", "New Vehicles", "Used Vehicles", "Service", "Parts")

# Work tasks and their priorities.
TASKS = {"validate": 100, "enrich": 80, "extract_contacts": 60, "retry_blocked": 40}
# Where rows came from.
WEB_CONTACTS = "website_contact_extraction"
WEB_SOURCES = ("website_enrichment", "website_resolution", WEB_CONTACTS)
# Items claimed of each task type in a cycle.
BATCHES = {"validate": 50, "enrich": 25, "extract_contacts": 25, "retry_blocked": 10}
