"""The taxonomy of business segments and the exclusion rules: fixed tables, and columns that read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.text import blank, fold, let

DEFAULT_SEGMENT = "прочее"

#: The segments in order, with their titles.
TITLES = {
    "stroitelstvo": "Строительство и ремонт",
    "nedvizhimost": "Недвижимость, агентства",
    "avto": "Авто: СТО, автосалоны, запчасти",
    "medicina": "Медицина, стоматология",
    "krasota": "Красота: салоны, барбершопы",
    "fitnes": "Фитнес и спорт",
    "obrazovanie": "Образование: курсы, автошколы, детские центры",
    "yurist_buh": "Юристы, бухгалтерия, консалтинг",
    "turizm": "Туризм, экскурсии, прокат",
    "torgovlya": "Торговля и опт",
    "proizvodstvo": "Производство",
    "logistika": "Логистика, грузоперевозки",
    "event": "Event, свадьбы, фото/видео",
    "mebel": "Мебель и интерьер",
    "vet": "Ветклиники, зоотовары",
    "klining_uslugi": "Клининг, бытовые услуги",
    "agro_vino": "Агро, виноделие",
    "it_svyaz": "IT и связь",
    "finansy": "Страхование, финансы",
    "reklama": "Реклама, полиграфия",
}

#: Segments whose sites should take bookings, and those that compete.
BOOKING_SEGMENTS = "avto medicina krasota fitnes obrazovanie turizm event vet".split()
COMPETITOR_SEGMENTS = "it_svyaz".split()

#: The words by which a text names a segment.
ALIASES = {
    "stroitelstvo": "строител; стройматериал; ремонт квартир; отделочн; натяжн; окна пвх; кровл; сантехник; электромонтаж",
    "nedvizhimost": "недвижим; риелтор; риэлтор; застройщик; новостройк",
    "avto": "автосервис; автосалон; автозапчаст; автомобил; шиномонтаж; автомойк; автопрокат; прокат авто; детейлинг; кузовн; автоэлектрик",
    "medicina": "стоматолог; клиник; медицинск; медцентр; лаборатори; оптик; диагностическ",
    "krasota": "салон красоты; барбер; маникюр; ногтев; косметолог; парикмахер; ресниц; эпиляц; массаж",
    "fitnes": "фитнес; тренажер; йога; танцев; кроссфит; единоборств; бассейн",
    "obrazovanie": "автошкол; курсы; детский центр; детский развивающ; учебный центр; репетитор; обучени; языковая школа; подготовка к егэ",
    "yurist_buh": "юридическ; юрист; адвокат; бухгалтер; нотариус; консалтинг; регистрация бизнеса",
    "turizm": "турагент; туристическ; турфирм; экскурси; прокат; морские прогулки; яхт; дайвинг",
    "torgovlya": "оптов; оптом; магазин одежды; одежд; обув; цветы; цветочн; ювелир; подарк; сувенир",
    "proizvodstvo": "производств; завод; фабрик; изготовлен; металлоконструкц; цех",
    "logistika": "грузоперевоз; транспортная компания; логистик; грузчик; эвакуатор; переезд; доставка грузов",
    "event": "праздник; свадеб; свадьб; фотограф; фотостуди; видеограф; ведущий; аниматор",
    "mebel": "мебел; мебель на заказ; изготовление мебели; кухни на заказ; шкафы-купе; дизайн интерьер; дизайнер интерьер",
    "vet": "ветеринар; ветклиник; зоомагазин; зоотовар; груминг",
    "klining_uslugi": "клининг; уборк; химчистк; прачечн; ателье; ремонт техники; ремонт бытовой техники; ремонт обуви; ремонт телефон; мастер на час",
    "agro_vino": "винодел; винзавод; фермер; агро; сельхоз; саженц; питомник растений",
    "it_svyaz": "веб-студи; веб студи; разработка сайт; создание сайт; провайдер; ремонт компьютер; it-компани; программн",
    "finansy": "страхов; осаго; кредитн; лизинг; ломбард; микрозайм; финансов",
    "reklama": "реклам; полиграф; типограф; вывеск; баннер",
}

#: The map tags of a segment.
TAGS = {
    "stroitelstvo": "craft=builder craft=window_construction craft=plumber craft=electrician craft=roofer shop=doityourself shop=hardware office=construction_company",
    "nedvizhimost": "office=estate_agent",
    "avto": "shop=car shop=car_repair shop=car_parts shop=tyres amenity=car_wash amenity=car_rental",
    "medicina": "amenity=dentist amenity=clinic amenity=doctors healthcare=laboratory shop=optician",
    "krasota": "shop=hairdresser shop=beauty shop=massage",
    "fitnes": "leisure=fitness_centre leisure=sports_centre leisure=dance",
    "obrazovanie": "amenity=driving_school amenity=language_school amenity=music_school amenity=training",
    "yurist_buh": "office=lawyer office=accountant office=notary office=consulting office=tax_advisor",
    "turizm": "office=travel_agent shop=travel_agency amenity=boat_rental amenity=bicycle_rental office=guide",
    "torgovlya": "shop=wholesale shop=trade shop=clothes shop=shoes shop=florist shop=gift shop=jewelry shop=mobile_phone",
    "proizvodstvo": "man_made=works craft=metal_construction craft=stonemason",
    "logistika": "office=logistics office=moving_company shop=storage_rental",
    "event": "shop=photo craft=photographer amenity=events_venue shop=party",
    "mebel": "shop=furniture shop=interior_decoration shop=kitchen craft=carpenter",
    "vet": "amenity=veterinary shop=pet shop=pet_grooming",
    "klining_uslugi": "shop=dry_cleaning shop=laundry craft=tailor craft=shoemaker shop=repair",
    "agro_vino": "craft=winery shop=farm shop=agrarian shop=garden_centre",
    "it_svyaz": "office=it office=telecommunication shop=computer",
    "finansy": "office=insurance office=financial office=financial_advisor shop=pawnbroker",
    "reklama": "office=advertising_agency shop=copyshop craft=signmaker craft=printer",
}

#: What a map is searched for, and a social network.
MAP_QUERIES = {
    "stroitelstvo": "строительная компания; ремонт квартир; окна пвх",
    "nedvizhimost": "агентство недвижимости; застройщик; новостройки",
    "avto": "автосервис; автозапчасти; шиномонтаж",
    "medicina": "стоматология; медицинский центр; медицинская лаборатория",
    "krasota": "салон красоты; барбершоп; косметология",
    "fitnes": "фитнес клуб; тренажерный зал; школа танцев",
    "obrazovanie": "автошкола; детский развивающий центр; курсы английского языка",
    "yurist_buh": "юридические услуги; бухгалтерские услуги; адвокат",
    "turizm": "туристическое агентство; экскурсии; морские прогулки",
    "torgovlya": "оптовая база; магазин одежды; цветочный магазин",
    "proizvodstvo": "производство; металлоконструкции; завод",
    "logistika": "грузоперевозки; транспортная компания; эвакуатор",
    "event": "организация праздников; свадебное агентство; фотостудия",
    "mebel": "мебель на заказ; кухни на заказ; дизайн интерьера",
    "vet": "ветеринарная клиника; зоомагазин; груминг",
    "klining_uslugi": "клининговая компания; химчистка; ремонт бытовой техники",
    "agro_vino": "винодельня; фермерское хозяйство; питомник растений",
    "it_svyaz": "веб студия; интернет провайдер; ремонт компьютеров",
    "finansy": "страховая компания; кредитный брокер; лизинг",
    "reklama": "рекламное агентство; полиграфия; наружная реклама",
}
GROUP_QUERIES = {
    "stroitelstvo": "строительство; ремонт квартир; натяжные потолки; стройматериалы",
    "nedvizhimost": "недвижимость; риелтор; новостройки",
    "avto": "автосервис; автозапчасти; шиномонтаж; прокат авто",
    "medicina": "стоматология; медицинский центр; клиника",
    "krasota": "салон красоты; барбершоп; маникюр; косметолог",
    "fitnes": "фитнес; тренажерный зал; йога; школа танцев",
    "obrazovanie": "автошкола; детский центр; курсы; репетитор",
    "yurist_buh": "юрист; бухгалтерские услуги; юридические услуги",
    "turizm": "экскурсии; турагентство; морские прогулки; прокат",
    "torgovlya": "оптом; магазин одежды; цветы; сувениры",
    "proizvodstvo": "производство; изготовление на заказ; металлоконструкции",
    "logistika": "грузоперевозки; грузчики; эвакуатор",
    "event": "организация праздников; свадьба; фотограф; ведущий",
    "mebel": "мебель на заказ; кухни на заказ; дизайн интерьера",
    "vet": "ветеринарная клиника; зоомагазин; груминг",
    "klining_uslugi": "клининг; химчистка; ателье; мастер на час",
    "agro_vino": "винодельня; фермерские продукты; саженцы",
    "it_svyaz": "разработка сайтов; веб студия; интернет провайдер",
    "finansy": "страхование; осаго; кредитный брокер",
    "reklama": "рекламное агентство; полиграфия; типография",
}

#: Brands that are no customers, beginnings of their names, and their mail domains.
BRANDS = (
    "магнит; пятерочка; перекресток; ашан; пуд; fix price; фикс прайс; мтс; мегафон; билайн; tele2; теле2; win mobile; волна мобайл; сбербанк; сбер; рнкб; "
    "генбанк; втб; почта банк; dns; эльдорадо; м.видео; мвидео; спортмастер; wildberries; вайлдберриз; ozon; озон; яндекс маркет; сдэк; cdek; boxberry; "
    "деловые линии; пэк; gloria jeans; playtoday; street beat; 585 золотой; технониколь; этм; главдоставка; кий авиа; самолет плюс; дятьково; аско "
).strip().split("; ")
BRAND_BEGINNINGS = ["сбер"]
BRAND_MAIL_DOMAINS = (
    "magnit.ru x5.ru mts.ru megafon.ru beeline.ru tele2.ru sberbank.ru sber.ru rncb.ru genbank.ru vtb.ru pochtabank.ru dns-shop.ru eldorado.ru mvideo.ru "
    "sportmaster.ru fix-price.com wildberries.ru ozon.ru cdek.ru boxberry.ru dellin.ru pecom.ru "
).split()

#: Public bodies as whole words, and by how they begin; places that other bases cover.
PUBLIC_WORDS = (
    r"администраци\w*|мфц|госуслуг\w*|прокуратур\w*|полици\w*|мвд|министерств\w*|росреестр\w*|налогов\w+ инспекци\w*|пенсионн\w+ фонд\w*|"
    r"социальн\w+ фонд\w*|гбу\w*|мбу\w*|гбоу|мбоу|мбдоу|гбдоу|гауз|муп|гуп|фгуп|фгбу\w*|суд|банкомат\w*|платежн\w+ терминал\w*|почта россии|"
    r"отделение почтов\w+ связи|(?:ф?г[абк]у[пз]?|гупс?|фгуп|ф?г[аб][пд]?оу|м[абк]у(?:до?)?|м[абк]д?оу|муп)(?:рк|с)?"
)
PUBLIC_BEGINNINGS = (
    r"поликлиник\w*\s*№|больниц\w*\s*№|школ\w*\s*№|лице\w*\s*№|(?:городск|районн|республиканск|центральн|детск)\w*\s+(?:больниц|поликлиник)\w*|"
    r"детск\w*\s+школ\w*\s+искусств|дши|дмш|дхш|фап|фельдшерск\w*|гимнази\w*|(?:государственн|муниципальн)\w*\s+(?:бюджетн|автономн|казенн|унитарн)\w*|"
    r"дворец\w*\s+(?:культуры|пионеров|спорта|водных)"
)
OTHER_BASES = (
    r"ресторан\w*|кафе|бар|паб|кофейн\w*|столовая|пиццери\w*|бургерн\w*|шаурм\w*|суши|фудкорт\w*|кондитерск\w*|пекарн\w*|отел\w*|гостиниц\w*|"
    r"мини-гостиниц\w*|гостев\w+\s+дом\w*|хостел\w*|пансионат\w*|санатори\w*|база отдыха"
)
#: Fixed value: what names no company but a community.
NOISE = (
    r"подслушано|барахолк\w*|объявлени\w*|вакансии|работа в|новости|сплетни|знакомств\w*|выпускник\w*|волонт\w*|благотворительн\w*|приют\w*|"
    r"клуб любителей|фан-?клуб\w*|типичн\w*|мемы|отдам даром|помогите"
)


def listed(table: dict[str, str], sep: str = "; ") -> list[tuple[str, str]]:
    """(value, key) of a table, in order."""
    return [(value, key) for key, values in table.items() for value in values.split(sep)]


def exact_names() -> dict[str, str]:
    """Keys, titles and aliases in one form; the first segment that has a name owns it."""
    found: dict[str, str] = {}
    for key, title in TITLES.items():
        for name in (key, title, *ALIASES[key].split("; ")):
            found.setdefault(" ".join(name.casefold().replace("ё", "е").split()), key)
    return found


def longest_first() -> list[tuple[str, str]]:
    return sorted(((a.replace("ё", "е"), key) for a, key in listed(ALIASES)), key=lambda x: -len(x[0]))


def segment_of(text: Column) -> Column:
    """The segment that a text is, or of its longest alias in it; of equal length the first."""
    names = F.create_map(*[F.lit(x) for kv in exact_names().items() for x in kv])
    return let(fold(text), lambda form: F.coalesce(F.try_element_at(names, form), *[F.when(form.contains(a), F.lit(key)) for a, key in longest_first()], F.lit(DEFAULT_SEGMENT)))


def title_of(key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TITLES.items() for x in kv]), blank(key)), F.lit("Прочее"))


def tag_segment(tags: Column) -> Column:
    """(segment, tag) of the first tag of the taxonomy that a map of tags has."""
    rules = F.array(*[F.struct(F.lit(kv.split("=")[0]).alias("k"), F.lit(kv.split("=")[1]).alias("v"), F.lit(key).alias("segment"), F.lit(kv).alias("tag")) for kv, key in listed(TAGS, " ")])
    found = F.get(F.filter(rules, lambda r: F.coalesce(F.try_element_at(tags, r["k"]) == r["v"], F.lit(False))), F.lit(0))
    return F.struct(F.coalesce(found["segment"], F.lit(DEFAULT_SEGMENT)).alias("segment"), F.coalesce(found["tag"], F.lit("")).alias("tag"))


def tag_groups() -> dict[str, list[str]]:
    """The values to ask a map for, by tag."""
    groups: dict[str, list[str]] = {}
    for kv, _ in listed(TAGS, " "):
        key, value = kv.split("=")
        if value not in groups.setdefault(key, []):
            groups[key].append(value)
    return groups


def map_query(box: str) -> str:
    """The request for all tagged places of a box (south, west, north, east)."""
    lines = [f'  nwr["{key}"~"^({"|".join(values)})$"]({box});' for key, values in sorted(tag_groups().items())]
    return "\n".join(["[out:json][timeout:180];", "(", *lines, ");", "out center tags;", ""])


def group_queries() -> dict[str, str]:
    """Keyword to segment; the last segment that has a keyword owns it."""
    return dict(listed(GROUP_QUERIES))


def mentions_alias(text: Column) -> Column:
    """Whether a page may belong to any segment."""
    return let(fold(text), lambda form: F.coalesce(*[F.when(form.contains(a), F.lit(True)) for a, _ in longest_first()], F.lit(False)))


def brand_pattern() -> str:
    import re

    names = "|".join(re.escape(b) for b in BRANDS)
    return rf"(?U)(?<!\w)(?:{names})(?!\w)|(?<!\w)(?:{'|'.join(BRAND_BEGINNINGS)})\w*"


def exclusion_flags(name: Column, category: Column) -> Column:
    """Why a company is no customer: its name is a brand's; name or category tell of a public body or of another base."""
    whole = F.trim(F.concat_ws(" ", fold(name), fold(category)))
    rules = [
        (fold(name).rlike(brand_pattern()), "excluded_chain"), (whole.rlike(rf"(?U)\b(?:{PUBLIC_WORDS})\b|\b(?:{PUBLIC_BEGINNINGS})"), "excluded_gov"),
        (whole.rlike(rf"(?U)\b(?:{OTHER_BASES})\b"), "excluded_other_base_type"),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(flag)) for test, flag in rules]))
