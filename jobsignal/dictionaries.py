"""Signs, synonym lists, removal lists and selectors the jobs work with.

Everything below the marker is fixed text that has to stay exactly as it is for the
results to be right; the helpers under it check the lists and turn them into the
shapes the Spark jobs use (regex alternations, literal maps, small frames).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values
# --------------------------------------------------------------------------

# Message signs, each a regular expression; later kinds win over earlier ones.
CHAT_SIGNS = {
    "tg_vacancy": ["__Subscription:__", "[^ ]Subscription", "__Подписка:__", "Подписка"],
    "tg_statistic": [
        "Статистика на Джині за запитом", "Статистика на Djinni за запитом",
        "Статистика на Джинне по запросу", "Statistics on Djinni for the query",
    ],
    "tg_service": [
        "Активные подписки", "Active Subscriptions",
        "Поставил на паузу подписку", "Снял с паузы подписку",
        "Волшебные слова", "Magic words",
        "Новая команда у бота", "Новая команда",
        "Подписку добавил", "Добавить все равно", "__Подсказка__",
        "создания подписки напишите", "Удалил все подписки",
        "/add", "/delete all", "/howmuch", "/help", "/list", "/login", "/pause", "/start",
        "/subscriptions", "/salaries", "/tips_on", "/unpause",
    ],
}

POSITION_COMPANY_SIGNS = [" в "]
EXPERIENCE_SIGNS = [
    "год опыта", "года опыта", "лет опыта",
    "year of experience", "years of experience",
    "Без опыта", "без опыта", "No experience",
]
SUBSCRIPTION_SIGNS = ["__Subscription:__", "Subscription:", "__Подписка:__", "Подписка:"]
SPLITTER_SIGNS = ["Subscription", "__Подписка:__", "Подписка"]

STATISTIC_SIGNS = {
    "vacancies_in_30d": [
        "Вакансий опубликовано", "Вакансии онлайн", "Вакансій за 30 днів", "Вакансий за 30 дней",
        "Job ads for 30 days", "Jobs for 30 days",
    ],
    "candidates_online": ["Кандидатов в поиске", "Кандидати онлайн", "Кандидаты онлайн", "Candidates online"],
    "salary": ["Вилка по зарплаті", "Вилка по зарплате", "Salary range"],
    "responses_to_vacancies": [
        "Відгуків на одну вакансію", "Откликов на одну вакансию", "Applications per job posting",
    ],
    "vacancies_per_week": ["Вакансій", "Вакансий", "Jobs"],
    "candidates_per_week": ["Кандидатів", "Кандидатов", "Candidates"],
}

URL_PATTERN = r"https?:\/\/djinni.co\/.*"
NUMERIC_PATTERN = r"([-+]?(?:\d*[.,]\d+|\d+))"
SALARY_TEMPLATE = r"\$?{numeric_pattern}"
SALARY_RANGE_TEMPLATE = r"\$?{numeric_pattern}-{numeric_pattern}"

# Synonyms: dictionary -> canonical value -> texts that mean it.
SYNONYMS = {
    "experience": {"0": ["Без опыта", "без опыта", "No experience", "Без досвіду"]},
    "lingvo": {
        "A1": ["English A1 - Beginner", "Beginner", "Beginner/Elementary", "Beginner / Elementary",
               "Англійська A1 - Початківець", "Англійська: A1 - Початківець"],
        "A2": ["English A2 - Elementary", "English Pre-Intermediate", "Elementary", "PreIntermediate",
               "Pre-Intermediate", "Англійська A2 - Елементарний", "Англійська: A2 - Елементарний"],
        "B1": ["English B1 - Intermediate", "Intermediate", "English Intermediate", "Англійська B1 – Середній",
               "Англійська: B1 – Середній"],
        "B2": ["English B2 - Upper Intermediate", "English Upper-Intermediate", "Upper Intermediate",
               "UpperIntermediate", "Upper-Intermediate", "Англійська B2 – Вище середнього",
               "Англійська: B2 – Вище середнього"],
        "C1": ["English C1 - Advanced", "Advanced/Fluent", "Advanced / Fluent", "Advanced", "Fluent",
               "Англійська C1 – Просунутий", "Англійська: C1 – Просунутий"],
        "C2": ["English C2 - Proficient", "Proficient", "Native", "English Native", "Носій мови"],
    },
    "employment": {
        "Full Remote": ["Тільки віддалено", "Віддалена робота"],
        "Office, Remote": ["Office or Remote", "Офіс або віддалено"],
        "Office": ["Office Work", "Тільки офіс", "Офіс"],
        "Part-time": ["Неповна / Парт-тайм"],
        "Hybrid Remote": ["Гібридний формат роботи", "В офісі та віддалено"],
    },
    "company_type": {
        "Product": ["Продукт"],
        "Outsource/Outstaff Agency": ["Agency", "Агенція"],
        "Outsource": ["Аутсорс"],
        "Outstaff": ["Аутстаф"],
        "Startup": ["Стартап"],
    },
    "candidate_locations": {
        "Ukraine": ["Україна"],
        "Countries of Europe or Ukraine": ["Країни Європи та Україна"],
        "EU": ["Країни ЄС", "Країни Європи крім України"],
        "Worldwide": ["Весь світ"],
        "Poland": ["Польща"],
        "United States": ["Сполучені Штати"],
        "Portugal": ["Португалія"],
        "Cyprus": ["Кіпр"],
        "Canada": ["Канада"],
    },
    "notes": {"Required knowledge of Ukrainian": ["Ukrainian: Native", "Українська: Носій мови"]},
}

# Fragments cut out of a value after synonyms were applied.
REMOVALS = {
    "experience": [
        "Only from", "Considering with", "Виключно від",
        "год опыта", "года опыта", "лет опыта",
        "Без опыта", "без опыта", "No experience", "Без досвіду",
        "year of experience", "years of experience", "years",
        "рік досвіду", "роки досвіду", "років досвіду",
    ],
    "lingvo": [
        "Upper Intermediate", "Upper-Intermediate", "Вище середнього", "English None", "Елементарний",
        "Intermediate", "Початківець", "Pre-Intermediate", "PreIntermediate", "Просунутий", "Elementary",
        "Proficient", "No English", "Середній", "Beginner", "Advanced", "Вільний", "Немає", "-", "–",
    ],
    "employment": ["Employment:", "Зайнятість:"],
    "domain": ["Domain:", "Домен:"],
    "offices": ["Офіс:", "Office:"],
    "mail_company": ["в ", "at "],
    "mail_description": ["Подробнее", "Детальніше", "Read more", "…"],
    "mail_subscription": ["Subscription:", "Подписка:", "Підписка:"],
}

# A layout-0 second detail with this text is a badge, not the experience.
PRODUCT_BADGE = "Український продукт"
SKILLS_HEADINGS = ["skills", "досвід"]
LANGUAGE_HEADINGS = ["language", "мовами"]
ENGLISH_NAMES = ["English", "Англійська"]
LANGUAGE_KEYS = ["English", "Ukrainian", "Russian"]
# Texts of failed and refused fetches.
FETCH_FAILED = "Connection error/timeout: unknown"
FETCH_REFUSED = ("Error for URL ", ": ")
# Steps from markup to text: pattern and what replaces it; (?U) makes \s any Unicode white space.
TEXT_STEPS = [
    (r"\n+", " "),
    (r"(?i)</?(p|div|li|h\d)[^>]*>", "\n"),
    (r"(?iU)<br\s*/?>", "\n"),
    (r"<[^>]+>", ""),
    (r"[ \t]+", " "),
    (r"\n+", "\n"),
    (r"(?U)\A{WS}+|{WS}+\z", ""),
    (r"(?Umd)^{WS}+|{WS}+$", ""),
    (r" +", " "),
    (r"(?U)\A{WS}+|{WS}+\z", ""),
]
BLOCKED_MARKS = ["Your IP address", "has been blocked"]


@dataclass(frozen=True)
class Selector:
    tag: str
    attr: str
    values: tuple[str, ...]


# Selectors by tag and attribute, then CSS paths as (tag, classes) steps.
MAIL_SIGNS = [
    Selector("div", "class", ("card",)),
    Selector("td", "style", ("padding-bottom:24px", "box-sizing:border-box")),
]
MAIL_V0 = {
    "card": Selector("td", "style", ("padding-bottom:24px",)),
    "position": Selector("a", "style", ("font-weight:bold", "font-size:18px")),
    "company": Selector("span", "class", ("djinni-whois-expanded",)),
    "details": Selector("p", "class", ("djinni-whois-expanded",)),
    "salary": Selector("span", "style", ("color:#4cae4c",)),
    "description": Selector("p", "style", ("margin:5px 0", "color:#333")),
}
MAIL_V1 = {
    "card": Selector("div", "class", ("card",)),
    "position": (("h3", ()), ("a", ())),
    "salary": (("h3", ()), ("span", ())),
    "company_box": Selector("div", "style", ("margin-bottom: 8px",)),
    "company": Selector("span", "class", ("details-text",)),
    "details": Selector("td", "class", ("details",)),
    "description": Selector("p", "style", ("margin:0", "line-height:1.5")),
    "subscription": Selector("div", "class", ("djinni-whois-expanded",)),
}
WEB = {
    "position": (("h1", ()), ("span", ())),
    "company": (("div", ("fs-5",)), ("div", ("col",))),
    "description": Selector("div", "class", ("job-post__description",)),
    "url": Selector("link", "rel", ("canonical",)),
    "main_tech": (("div", ("col",)), ("div", ("fw-medium",))),
    "more_skills": Selector("link", "rel", ("canonical",)),
    "second_skills": (("div", ("text-secondary",)), ("div", ("col",))),
    "card": (("aside", ()), ("div", ("card", "card-body"))),
}

# Mails up to this instant use layout 0, later ones layout 1.
LAYOUT_SWITCH = "2025-01-24 00:00:00"
# Where ingestion starts when nothing was stored yet.
START_DATE = "2020-01-01 00:00:00"

# --------------------------------------------------------------------------
# Shapes used by the jobs
# --------------------------------------------------------------------------

SALARY_PATTERN = SALARY_TEMPLATE.replace("{numeric_pattern}", NUMERIC_PATTERN)
SALARY_RANGE_PATTERN = SALARY_RANGE_TEMPLATE.replace("{numeric_pattern}", NUMERIC_PATTERN)


def any_of(signs: list[str]) -> str:
    """Alternation of signs as one regular expression."""
    return "|".join(signs)


def synonym_pairs(name: str) -> list[tuple[str, str]]:
    """(text, canonical value) pairs of a dictionary in list order."""
    return [(text, target) for target, texts in SYNONYMS.get(name, {}).items() for text in texts]


def removal_order(name: str) -> list[str]:
    """Removal fragments, longest first; equal lengths keep list order."""
    return sorted(REMOVALS.get(name, []), key=len, reverse=True)


SYNONYM_SCHEMA = T.StructType([
    T.StructField("dict", T.StringType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("source_text", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
])
REMOVAL_SCHEMA = T.StructType([
    T.StructField("dict", T.StringType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("pattern", T.StringType(), False),
])


def check_dictionaries(synonyms: dict = SYNONYMS, removals: dict = REMOVALS) -> None:
    """Refuse lists that would make normalization ambiguous or empty."""
    for name, targets in synonyms.items():
        texts = [t for group in targets.values() for t in group]
        if not all(isinstance(t, str) and t.strip() for t in [*texts, *targets]):
            raise ValueError(f"dictionary {name}: texts and targets must be non-blank strings")
        if len(set(texts)) != len(texts):
            raise ValueError(f"dictionary {name}: a text is listed twice")
        chained = {t for target, group in targets.items() for t in texts if t == target and t not in group}
        if chained:
            raise ValueError(f"dictionary {name}: targets that are synonyms themselves: {sorted(chained)}")
    for name, patterns in removals.items():
        if not all(isinstance(p, str) and p for p in patterns):
            raise ValueError(f"removals {name}: patterns must be non-empty strings")


def synonyms_frame(spark: SparkSession) -> DataFrame:
    """All synonyms as a small frame; its size is fixed, so joins may broadcast it."""
    check_dictionaries()
    rows = [(name, i, text, target)
            for name in SYNONYMS for i, (text, target) in enumerate(synonym_pairs(name))]
    return spark.createDataFrame(rows, SYNONYM_SCHEMA)


def removals_frame(spark: SparkSession) -> DataFrame:
    check_dictionaries()
    rows = [(name, i, p) for name in REMOVALS for i, p in enumerate(REMOVALS[name])]
    return spark.createDataFrame(rows, REMOVAL_SCHEMA)
