"""Fixed values that results depend on: hosts, mail providers, signals, boxes and priorities."""

SOCIAL_HOSTS = "vk.com vk.ru m.vk.com instagram.com t.me telegram.me ok.ru facebook.com youtube.com youtu.be wa.me whatsapp.com taplink.cc taplink.ru linktr.ee dzen.ru rutube.ru".split()
PLATFORM_HOSTS = (
    "yandex.ru yandex.com 2gis.ru avito.ru youla.ru booking.com tvil.ru sutochno.ru ostrovok.ru tripadvisor.ru tripadvisor.com zoon.ru "
    "flamp.ru yell.ru hh.ru pulscen.ru tiu.ru satu.kz ozon.ru wildberries.ru dikidi.net dikidi.ru yclients.com sites.google.com "
    "2gis.com goo.gl vk.cc clck.ru bit.ly t.co tinyurl.com"
).split()
FREE_MAIL_HOSTS = (
    "mail.ru inbox.ru list.ru bk.ru internet.ru ya.ru yandex.ru yandex.com gmail.com googlemail.com rambler.ru outlook.com hotmail.com "
    "icloud.com me.com yahoo.com ukr.net i.ua yandex.ua yandex.by yandex.kz yandex.kg tut.by bigmir.net meta.ua mail.ua rambler.ua "
    "live.com msn.com aol.com proton.me protonmail.com pm.me gmx.com gmx.net zoho.com fastmail.com"
).split()
TYPO_PROVIDERS = "mail.ru yandex.ru gmail.com inbox.ru rambler.ru hotmail.com outlook.com yahoo.com".split()
SERVICE_LOCALS = "info mail support admin rating contact contacts office sales post help webmaster postmaster noreply no-reply email name user test example".split()
PLACEHOLDER_LOCALS = "name your yourname user username example sample test email".split()
PLACEHOLDER_NAMES = "example domain yourdomain yoursite sitename mysite".split()
FILE_ENDINGS = "png jpg jpeg gif svg webp ico css js json php html htm pdf woff woff2 ttf eot map mp4 zip".split()
BLOCKED_HOSTS = (
    "beget.com beget.ru reg.ru nic.ru timeweb.ru timeweb.com jino.ru hostia.ru sprinthost.ru dikidi.net dikidi.ru yclients.com tilda.cc "
    "tilda.ws wix.com wixpress.com sferum.ru vk.com vk.ru vk-portal.net roszdravnadzor.ru rospotrebnadzor.ru roskomnadzor.ru gov.ru "
    "gosuslugi.ru sentry.io onmicrosoft.com jabber.ru jabber.org xmpp.ru xmpp.jp"
).split()
SIGNAL_ORDER = "no_website site_dead no_https no_mobile no_online_booking site_builder outdated".split()
PITCHES = {
    "no_website": "Сайт с нуля", "site_dead": "Сайт не работает", "no_https": "Модернизация сайта", "no_mobile": "Адаптив/редизайн",
    "no_online_booking": "Онлайн-запись / бот", "site_builder": "Собственная разработка", "outdated": "Редизайн",
}
DEFAULT_PITCH = "Автоматизация/боты/CRM"
SOURCE_PRIORITY = {"Я.Карты": 50, "Yandex": 50, "OSM": 40, "VK": 30, "Crawler": 20}
ADDRESS_WORDS = {"улица": "ул", "проспект": "пр", "переулок": "пер", "набережная": "наб", "площадь": "пл", "шоссе": "ш"}
QUARANTINE_FLAGS = ["vk_no_primary_segment_signal", "vk_noise_primary", "vk_no_own_website"]
EXCLUDED_FLAGS = ["excluded_chain", "excluded_gov", "excluded_other_base_type"]
GENERIC_NAMES = "бар кафе клуб кофейня паб пиццерия ресторан столовая фастфуд фудкорт шашлычная закусочная".split()
#: Endings by which an address in letters moved by 13 is told, and those that only such addresses have.
COMMON_ENDINGS = (
    "ru su рф com net org info biz ua by kz uz md ge am az kg tj tm io me pro expert online site shop store tech club tv cc co eu de uk us fr it es pl cz "
    "fi lv lt ee asia xyz top app dev cloud agency studio design tours tour travel city today news life world group company email link live space website "
    "digital ooo moscow rus center clinic dental school academy market pw ws name mobi gov edu int yalta crimea spb msk one art bar cafe fit gold land "
    "media team tips zone photo pics gallery"
).split()
MOVED_ENDINGS = "pbz arg vasb ovm".split()
#: Labels that stand between a name and its ending.
SECOND_LEVELS = "com net org co msk spb pp gov edu ac".split()
#: Fixed value: domains of gambling and the like.
SPAM_DOMAINS = r"casino|kazino|1xbet|poker|slots?(?:[-.]|$)|porn|xxx|vulkan|888|(?:^|[-.])bet(?:[-.]|$)"
#: What no address of a company contains, and how a company's address begins, the best first.
EMAIL_BLOCKS = (
    "example. @domain @test. noreply no-reply do-not-reply @sentry @wixpress @2x.png .png .jpg .jpeg .webp .svg .gif @react @vue @babel @types @material "
    "@material-ui @yandex-team @google-analytics @cloudflare @gravatar webmaster@ postmaster@ abuse@ hostmaster@ admin@yandex admin@google support@google "
    "support@apple your@email name@email test@"
).split()
SITE_PREFIXES = "reservation reservations booking book reception info order zakaz sales manager office contact rsv delivery".split()
OUTREACH_PREFIXES = "info office sales zakaz order manager contact director reception booking".split()
GROUP_PREFIXES = "reservation reservations booking reserve book reception info sales office manager order zakaz".split()
GROUP_EMAIL_BLOCKS = "noreply no-reply example. @vk.com @vkontakte".split()
#: Fixed value: addresses that outreach never takes.
OUTREACH_BLOCKS = r"(?i)(?:^|@)(?:example(?:\.|@)|test(?:\.|@))|no-?reply|mailer-daemon|postmaster@|webmaster@|abuse@|@.*\.gov\.ru$|@stacks\.vk-portal\.net$"
HARD_REJECT_FLAGS = ["outside_crimea", *QUARANTINE_FLAGS]
#: Hosts of profiles on social networks, parts of links that only share, and words of pages with contacts.
PROFILE_HOSTS = "vk.com vk.ru t.me telegram.me telegram.org instagram.com ok.ru facebook.com wa.me whatsapp.com".split()
SHARE_PARTS = "share sharer send_to post=".split()
CONTACT_HINTS = "contact; kontakt; контакт; o-nas; o_nas; about; о нас; о компании; связ; реквизит; как нас найти; где мы; обратн; feedback".split("; ")
SITEMAP_HINTS = "contact about kontakt kontakty feedback obratnaya".split()
#: Spellings of cities, and names that are looked for in addresses.
CITY_ALIASES = {"малореречен.": "Малореченское", "малореченское": "Малореченское", "береговое (феод.)": "Береговое", "севастополь г": "Севастополь", "г. севастополь": "Севастополь"}
CITY_HINTS = (
    "Симферополь; Ялта; Севастополь; Евпатория; Феодосия; Керчь; Алушта; Судак; Саки; Бахчисарай; Коктебель; Партенит; Гурзуф; Новый Свет; Форос; "
    "Симеиз; Алупка; Ливадия; Массандра; Мисхор; Канака; Орджоникидзе; Щёлкино; Морское; Малореченское"
).split("; ")
#: Cities of the social network by id, and the errors that end its use.
GROUP_CITIES = {
    818: "Ялта", 627: "Симферополь", 185: "Севастополь", 799: "Евпатория", 1483: "Феодосия", 478: "Керчь", 2510: "Алушта", 7188: "Судак", 4331: "Саки", 475: "Бахчисарай",
    5490687: "Коктебель", 5490709: "Гурзуф", 5490654: "Партенит", 5490729: "Симеиз", 5490701: "Алупка",
}
DEAD_TOKEN_CODES = [5, 15, 27, 28]
FLOOD_CODE = 9
#: City, least and greatest latitude, least and greatest longitude; the first that holds a point names it.
CITY_BOXES = [
    ("Гурзуф", 44.530, 44.580, 34.265, 34.310), ("Партенит", 44.560, 44.595, 34.320, 34.365), ("Ливадия", 44.460, 44.495, 34.130, 34.170),
    ("Массандра", 44.500, 44.530, 34.180, 34.215), ("Мисхор", 44.420, 44.455, 34.080, 34.115), ("Алупка", 44.405, 44.435, 34.040, 34.075),
    ("Симеиз", 44.385, 44.420, 33.985, 34.030), ("Форос", 44.380, 44.420, 33.770, 33.810), ("Кореиз", 44.430, 44.460, 34.085, 34.115),
    ("Ялта", 44.435, 44.535, 34.115, 34.270), ("Малореченское", 44.733, 44.770, 34.690, 34.730), ("Солнечногорское", 44.770, 44.800, 34.625, 34.665),
    ("Рыбачье", 44.795, 44.830, 34.565, 34.605), ("Семидворье", 44.700, 44.735, 34.470, 34.510), ("Алушта", 44.610, 44.720, 34.350, 34.480),
    ("Симферополь", 44.880, 45.010, 33.940, 34.180), ("Кача", 44.770, 44.815, 33.530, 33.580), ("Балаклава", 44.480, 44.520, 33.580, 33.620),
    ("Орлиное", 44.450, 44.490, 33.730, 33.780), ("Севастополь", 44.500, 44.755, 33.380, 33.745), ("Заозёрное", 45.135, 45.175, 33.295, 33.340),
    ("Новофёдоровка", 45.115, 45.155, 33.530, 33.580), ("Витино", 45.130, 45.170, 33.190, 33.235), ("Окуневка", 45.300, 45.345, 32.835, 32.890),
    ("Межводное", 45.430, 45.475, 32.770, 32.825), ("Черноморское", 45.490, 45.530, 32.680, 32.730), ("Саки", 45.110, 45.150, 33.575, 33.630),
    ("Евпатория", 45.180, 45.235, 33.310, 33.410), ("Береговое", 45.060, 45.095, 35.310, 35.355), ("Приморский", 45.085, 45.120, 35.270, 35.310),
    ("Орджоникидзе", 44.945, 44.975, 35.355, 35.395), ("Курортное", 44.910, 44.945, 35.220, 35.260), ("Коктебель", 44.940, 44.985, 35.225, 35.290),
    ("Морское", 44.815, 44.850, 34.965, 35.005), ("Феодосия", 45.020, 45.075, 35.345, 35.430), ("Новый Свет", 44.815, 44.840, 34.890, 34.920),
    ("Судак", 44.820, 44.870, 34.940, 35.020), ("Щёлкино", 45.420, 45.450, 35.815, 35.860), ("Керчь", 45.310, 45.405, 36.420, 36.530),
    ("Соколиное", 44.625, 44.660, 33.910, 33.955), ("Бахчисарай", 44.715, 44.785, 33.840, 33.950), ("Гаспра", 44.420, 44.445, 34.095, 34.135),
    ("Голубой Залив", 44.420, 44.450, 34.005, 34.045), ("Малый Маяк", 44.640, 44.665, 34.405, 34.435), ("Утёс", 44.620, 44.645, 34.395, 34.425),
    ("Никита", 44.515, 44.535, 34.220, 34.250), ("Песчаное", 44.835, 44.875, 33.660, 33.710), ("Угловое", 44.890, 44.920, 33.580, 33.625),
    ("Любимовка", 44.685, 44.715, 33.555, 33.605), ("Кацивели", 44.395, 44.420, 33.970, 34.005), ("Понизовка", 44.405, 44.430, 33.870, 33.905),
]
#: Corners (latitude, longitude) of the peninsula's contour; OpenStreetMap contributors, ODbL 1.0. The box closes a gap on land.
CONTOUR = [
    (45.39599, 32.47975), (45.34689, 32.49369), (45.31885, 32.62482), (45.36758, 32.77860), (45.32762, 32.98328), (45.35841, 32.92364), (45.44358, 33.20529), (45.30796, 33.02427),
    (45.32528, 32.98667), (45.14799, 33.25990), (45.18072, 33.44105), (44.99357, 33.60447), (44.86748, 33.60675), (44.83429, 33.54982), (44.62448, 33.50965), (44.60997, 33.60199),
    (44.58321, 33.37863), (44.38641, 33.77722), (44.42946, 34.12790), (44.49549, 34.16842), (44.54889, 34.34716), (44.71037, 34.45704), (44.81031, 34.72267), (44.84083, 34.96735),
    (44.79241, 35.08216), (44.96546, 35.26154), (44.94709, 35.38367), (44.98766, 35.35733), (45.01326, 35.42547), (45.05218, 35.38573), (45.11796, 35.49677), (45.11146, 35.68095),
    (44.99915, 35.84070), (45.05927, 36.37444), (45.09597, 36.45351), (45.21111, 36.40173), (45.28355, 36.41698), (45.31747, 36.49451), (45.34074, 36.46128), (45.38258, 36.64705),
    (45.43776, 36.59659), (45.48351, 36.34410), (45.46211, 36.12586), (45.37091, 35.97593), (45.47327, 35.84524), (45.33446, 35.72022), (45.29155, 35.49425), (45.39891, 35.31800),
    (45.66618, 35.04454), (45.92833, 34.87944), (46.14561, 34.81975), (46.07181, 34.78841), (46.10086, 34.67385), (46.00629, 34.75911), (46.05293, 34.78153), (45.98548, 34.82325),
    (46.01578, 34.83521), (45.80928, 34.82713), (45.85424, 34.90420), (45.62259, 35.06277), (45.29385, 35.47305), (45.25952, 35.38411), (45.41325, 35.01536), (45.48927, 35.10998),
    (45.68175, 34.98292), (45.72220, 34.84314), (45.75024, 34.87799), (45.72770, 34.72062), (45.79222, 34.78364), (45.82332, 34.74976), (45.79333, 34.65406), (45.85684, 34.67580),
    (45.89639, 34.79091), (45.78657, 34.52186), (45.94977, 34.63901), (45.98861, 34.55516), (45.91426, 34.58186), (45.92900, 34.52495), (45.87311, 34.48622), (45.95166, 34.47913),
    (46.03670, 34.35649), (46.00408, 34.28340), (46.05070, 34.27874), (46.06786, 34.10967), (46.00412, 34.20233), (45.95231, 34.21271), (45.93718, 34.14782), (45.98223, 34.10096),
    (46.00152, 34.18628), (46.18059, 33.82093), (46.11956, 33.80256), (46.15463, 33.72926), (46.12936, 33.61523), (45.94626, 33.61799), (45.93529, 33.75898), (45.90620, 33.67914),
    (45.84303, 33.68310), (45.89028, 33.61366), (45.75527, 33.26341), (45.79158, 33.17094), (45.72029, 33.14079), (45.39636, 32.48002), (45.39599, 32.47975),
]
CONTOUR_BOX = (44.38, 44.78, 33.35, 33.83)
