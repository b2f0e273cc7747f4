"""Fixed values. They decide results, so they are stated as plain text here."""

# --- fixed values: content hash ------------------------------------------------
CONTENT_HASH_VERSION = "v4-drop-legacy-area-code"
CONTENT_HASH_FIELDS = (
    "contentid", "contenttypeid", "title", "addr1", "addr2", "zipcode", "mapx", "mapy",
    "mlevel", "lDongRegnCd", "lDongSignguCd", "sigungucode",
    "lclsSystm1", "lclsSystm2", "lclsSystm3", "firstimage", "modifiedtime",
)

# --- fixed values: valid coordinates and text widths ---------------------------
LON_RANGE = (124, 132)
LAT_RANGE = (33, 39)
TITLE_WIDTH = 200
INFOCENTER_WIDTH = 200

# --- fixed values: level-1 / level-2 code -> service category ------------------
# (level 1, level 2 or None for any, category); first rule that fits wins.
CATEGORY_RULES = (
    ("FD", "FD05", 2),
    ("FD", None, 1),
    ("SH", None, 3),
    ("VE", None, 4),
    ("HS", None, 4),
    ("C01", None, 4),
    ("EV", None, 4),
    ("NA", None, 5),
    ("EX", None, 6),
    ("LS", None, 6),
    ("AC", None, 7),
)
CATEGORY_NAMES = (
    (1, "식당"), (2, "카페"), (3, "쇼핑"), (4, "관광지"), (5, "자연"), (6, "액티비티"), (7, "숙박"),
)
RANK_TAG_FORMAT = ("인기 ", " ", "위")
RANK_TAG_TOP_N = 10

# --- fixed values: API result codes --------------------------------------------
OK_CODES = ("0000", "00")
NO_DATA_CODES = ("03", "0003")
QUOTA_CODES = ("22", "0022")

# --- fixed values: text patterns ------------------------------------------------
TAG_PATTERN = r"<[^>]+>"
ENTITY_PATTERN = r"&[a-zA-Z]+;|&#\d+;"
HANGUL = "가-힣"
NAME_ALPHABET = "0-9a-z가-힣"
CITY_SUFFIXES = ("시", "군")
REGION_SUFFIXES = ("특별자치시", "시", "군", "구")

# --- fixed values: trend collection and scoring --------------------------------
SEARCH_WORDS = ("여행", "관광", "맛집")
CHANNELS = ("blog", "cafe")
PROPER_NOUN_TAGS = ("NNP",)
PLACE_CATEGORIES = ("AT4", "FD6", "CE7", "AD5")
MIN_FREQUENCY = 3
TOP_N = 20
PAGE_SIZE = 50
DIVERSITY_BONUS = 1.3
MENTION_WEIGHT = 5.0
LIKE_WEIGHT = 1.0
REVIEW_WEIGHT = 2.0
RATING_WEIGHT = 0.5
MENTION_DECAY = 0.99
MATCH_RADIUS_M = 1000.0
EARTH_RADIUS_M = 6371000.0
CONTAINMENT_MIN_LENGTH = 4
LOCAL_ZONE = "Asia/Seoul"

# --- fixed values: queue and batch sizes ----------------------------------------
DETAIL_BATCH_LIMIT = 300
IMAGE_RECOVERY_LIMIT = 500
NOTIFY_LIMIT = 10
NOTIFY_BATCH = 500

# --- fixed values: decay by place class (design text) ---------------------------
CLASS_DECAY = (("AT4", 0.85), ("AD5", 0.85), ("FD6", 0.70), ("CE7", 0.70))
DECAY_THRESHOLD = 0.01

# --- fixed values: cities (name, short name, longitude, latitude) ---------------
CITIES = (
    ("춘천시", "춘천", 127.7292, 37.8748),
    ("원주시", "원주", 127.9247, 37.3422),
    ("강릉시", "강릉", 128.8781, 37.7519),
    ("동해시", "동해", 129.1139, 37.5247),
    ("태백시", "태백", 128.9856, 37.1640),
    ("속초시", "속초", 128.5919, 38.2070),
    ("삼척시", "삼척", 129.1650, 37.4494),
    ("홍천군", "홍천", 127.8879, 37.6975),
    ("횡성군", "횡성", 127.9851, 37.4916),
    ("영월군", "영월", 128.4614, 37.1838),
    ("평창군", "평창", 128.3890, 37.3700),
    ("정선군", "정선", 128.6606, 37.3800),
    ("철원군", "철원", 127.3130, 38.1467),
    ("화천군", "화천", 127.7078, 38.1064),
    ("양구군", "양구", 128.0254, 38.1097),
    ("인제군", "인제", 128.1706, 38.0694),
    ("고성군", "고성", 128.4677, 38.3806),
    ("양양군", "양양", 128.6192, 38.0784),
)

# --- fixed values: province names ------------------------------------------------
# Names below province level stand further down; code tables may add more, and
# `operators.normalize.region_alias_expand` derives short forms by rule.
PROVINCES = (
    "서울", "서울특별시", "부산", "부산광역시", "대구", "대구광역시",
    "인천", "인천광역시", "광주", "광주광역시", "대전", "대전광역시",
    "울산", "울산광역시", "세종", "세종특별자치시",
    "경기", "경기도", "강원", "강원도", "강원특별자치도",
    "충북", "충청북도", "충남", "충청남도",
    "전북", "전라북도", "전북특별자치도", "전남", "전라남도",
    "경북", "경상북도", "경남", "경상남도",
    "제주", "제주도", "제주특별자치도",
)

# --- fixed values: cities, counties and districts, with names no longer in use -------
DISTRICTS = tuple("""
남구 동구 북구 서구 중구 가평군 강남구 강동구 강릉시 강북구 강서구 강진군 강화군
거제시 거창군 경산시 경주시 계룡시 계양구 고령군 고성군 고양시 고창군 고흥군 곡성군
공주시 과천시 관악구 광명시 광산구 광양시 광주시 광진구 괴산군 구례군 구로구 구리시
구미시 군산시 군위군 군포시 금산군 금정구 금천구 기장군 김제시 김천시 김포시 김해시
나주시 남동구 남원시 남해군 노원구 논산시 단양군 달서구 달성군 담양군 당진시 대덕구
도봉구 동래구 동작구 동해시 마산시 마포구 목포시 무안군 무주군 문경시 밀양시 보령시
보성군 보은군 봉화군 부안군 부여군 부천시 부평구 사상구 사천시 사하구 산청군 삼척시
상주시 서산시 서천군 서초구 성남시 성동구 성북구 성주군 속초시 송파구 수성구 수영구
수원시 순창군 순천시 시흥시 신안군 아산시 안동시 안산시 안성시 안양시 양구군 양산시
양양군 양주시 양천구 양평군 여수시 여주시 연수구 연제구 연천군 영광군 영덕군 영도구
영동군 영암군 영양군 영월군 영주시 영천시 예산군 예천군 오산시 옥천군 옹진군 완도군
완주군 용산구 용인시 울릉군 울주군 울진군 원주시 유성구 은평구 음성군 의령군 의성군
의왕시 이천시 익산시 인제군 임실군 장성군 장수군 장흥군 전주시 정선군 정읍시 제주시
제천시 종로구 중랑구 증평군 진도군 진안군 진주시 진천군 진해시 창녕군 창원시 천안시
철원군 청도군 청송군 청양군 청원군 청주시 춘천시 충주시 칠곡군 태백시 태안군 통영시
파주시 평창군 평택시 포천시 포항시 하남시 하동군 함안군 함양군 함평군 합천군 해남군
홍성군 홍천군 화성시 화순군 화천군 횡성군 남양주시 남제주군 동대문구 동두천시 미추홀구
부산진구 북제주군 서귀포시 서대문구 영등포구 의정부시 해운대구 세종특별자치시
""".split())

# --- fixed values: travel stop words ---------------------------------------------
STOPWORDS = (
    "여행", "관광", "추천", "후기", "리뷰", "방문", "코스",
    "드라이브", "산책", "데이트", "나들이", "소풍",
    "사진", "인증", "뷰", "전망", "풍경",
    "맛집", "카페", "식당", "음식", "음료", "커피", "디저트",
    "주차", "입장료", "가격", "할인", "예약", "운영",
    "주말", "평일", "당일", "패키지",
    "곳", "장소", "명소", "핫플", "스팟", "포인트", "거리",
    "시간", "분", "정도", "이상", "이하", "부근", "근처", "주변",
)

# --- fixed values: embedding text labels (design text) ----------------------------
EMBEDDING_LABELS = ("여행지명", "지역", "대표 키워드", "카테고리", "소개")
EMBEDDING_SEPARATOR = "\n"
