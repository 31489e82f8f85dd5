"""Word lists and patterns of the gap scan.

They decide which terms are reported, so they stand here as they are used.
Every list can be replaced through `GapRules`.
"""

STAGES = (
    "flowering", "vegetative", "germination", "tillering", "maturity",
    "fruiting", "ripening", "sowing", "transplanting", "nursery",
    "panicle initiation", "grain filling", "boll formation", "milking",
    "dough", "developmental stage", "pre-flowering", "post harvest",
    "post-harvest", "harvesting", "seedling", "budding", "tuber formation",
    "pod formation", "knee high", "reproductive",
)

CELL = r"^(?:[A-Z][a-z]+|[a-z]{4,})(?:[ /-][A-Za-z]+){0,2}$"

# Word characters are letters, digits and the underscore of any script.
OBJECT = (
    r"(?<![\p{L}\p{N}_])(?:in|of|on|for)\s+([A-Za-z]{4,}(?:[ -][a-z]{3,})?)(?![\p{L}\p{N}_])"
)
ADVISORY = (
    r"(?i)(?<![\p{L}\p{N}_])(spray|drench|apply|irrigat[\p{L}\p{N}_]+|sow|transplant|prune|"
    r"harvest[\p{L}\p{N}_]*|छिड़काव|सिंचाई|बुवाई|कटाई|ಸಿಂಪರಣೆ|ನೀರಾವರಿ)(?![\p{L}\p{N}_])"
)
HEAD = r"^([A-Z][a-z]+(?:[ /-][A-Za-z]+){0,2})"
TITLE = r"^[A-Za-z][a-z]+(?:[ /-][A-Za-z]+){0,2}$"
CHEMICAL = (
    r"(?i)(zim|phos|thrin|mycin|conazole|prid|xam|sulf|sulph|copper|mancozeb|"
    r"neem|urea|potash|borax|gypsum|zinc|sulphur|carb|azole|amide|ate)$"
)
INDIC_WORD = r"[\x{0900}-\x{097F}\x{0C80}-\x{0CFF}]{3,}"
INDIC_TRIM = "।॥,.()-"
INDIC_ENDINGS = ("ेंगे", "करें", "कर", "ाएं", "ायें", "ना", "ने")

STOP = tuple("""
the and for of in to at on with by from as is are be advised farmers should may
crop crops stage advisory advisories district districts weather rainfall rain
temperature management spray apply water soil plant plants field fields per day
days week light heavy maximum minimum humidity wind speed sky condition forecast
expected during after before agromet bulletin department india meteorological
university krishi vigyan kendra general vegetative flowering sowing harvesting
maturity fruiting ripening control use time state pest disease avoid maintain
provide monitor remove ensure conserve keep give take make store cover spraying
early late morning evening night today tomorrow next last this that there here
very likely places moderate isolated warning intensity distribution probability
scattered thunderstorm regional lightning govt ministry earth sciences centre
normal link plain below above eastern western southern northern humid annexure
many most few actual likely dry wet fair clear cloudy overcast rise fall change
arid irrigated north south east west partial total note table page figure source
farmer advisory issued valid period week ending dated contact email phone website
""".split())

NOT_A_SUBJECT = tuple("""
development preparation growing fruit leaf root stem seed soil fertilizer
fertiliser micronutrient micronutrients moisture nutrient nutrients irrigation
thinning spacing weeding mulching storage marketing advisory advisories agro
general condition damage symptom symptoms infestation incidence management
protection quality yield production area block taluk village orchard nursery
aphids aphid thrips whitefly borer caterpillar larvae mite mites jassid hopper
weevil weevils worm worms blight rust wilt mildew mold mould spot mosaic virus
bacteria fungus fungal insect insects trap traps dose spraying drenching
livestock animals birds plants crops seeds fruits leaves roots
""".split())

LEADING_VERBS = tuple("""
provide apply maintain postpone harvest go do keep give take make store cover
avoid monitor remove ensure conserve destroy spray drench irrigate sow prune
plant grow use continue start stop repeat follow adopt undertake carry complete
after before during if when where while one two three all any some this that
land crop farmers it they there here at in on for with by from as is are be
install place put set fix mix add dilute drain check inspect scout collect
active delayed raised early late kharif rabi zaid summer winter season sowing
plantation fall total partial normal above below light heavy moderate
""".split())

INDIC_STOP = tuple("""
करें कर करने किया जाए जाये जाता होने होगा रहे रहें लीटर किलो ग्राम मिली प्रति
हेक्टेयर एकड़ दर से का की के को में पर और या भी नहीं तथा एवं लिए साथ बाद पहले
दौरान समय दिन सप्ताह वर्षा वर्ाा बारिश तापमान मौसम फसल फसलों किसान किसानों
सलाह सलाहः दी जानी चाहिए संभावना अनुसार अनुसारः मात्रा छिड़काव कीटनाशकों दवा
उपयोग प्रयोग रोकथाम नियंत्रण अवस्था स्थिति क्षेत्र जिला जिले राज्य विभाग केंद्र
बीज किलोग्राम धकलोग्राम कुंतल क्विंटल मिलीलीटर सेंटीमीटर औसत अधिकतम न्यूनतम
""".split())

FUNCTION_WORDS = tuple("""
or the for is at and before after based with of to a an its their this that
""".split())
