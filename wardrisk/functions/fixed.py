"""Names, word lists, thresholds and lookup figures.

They are data the results depend on, so they are stated plainly here and nowhere
else.  Every operator takes them as arguments; these are only the defaults.
"""

# Districts in geo-parsing priority order.
DISTRICTS = [
    "asemrowo", "benowo", "bubutan", "bulak", "dukuh pakis",
    "gayungan", "genteng", "gubeng", "gunung anyar", "jambangan",
    "karang pilang", "kenjeran", "krembangan", "lakarsantri",
    "mulyorejo", "pabean cantian", "pakal", "rungkut", "sambikerep",
    "sawahan", "semampir", "simokerto", "sukolilo", "sukomanunggal",
    "tambaksari", "tandes", "tegalsari", "tenggilis mejoyo",
    "wiyung", "wonocolo", "wonokromo",
]

# Spellings found in the data, mapped to the district they stand for.
DISTRICT_ALIASES = {
    "aseminrowo": "asemrowo",
    "pabean cantikan": "pabean cantian",
    "tenggilis": "tenggilis mejoyo",
}

# Stop words removed before topic modelling.
TOPIC_STOPWORDS = [
    "yang", "di", "ke", "dari", "pada", "dalam", "untuk", "dengan", "dan", "atau", "ini", "itu",
    "juga", "sudah", "saya", "anda", "dia", "mereka", "kita", "kami", "akan", "bisa", "ada",
    "tidak", "bukan", "belum", "sangat", "paling", "lebih", "karena", "sebab", "oleh", "seperti",
    "sebagai", "saat", "ketika", "setelah", "sebelum", "jika", "kalau", "apabila", "hingga",
    "sampai", "tentang", "bagi", "menurut", "antara", "terhadap", "kepada", "namun", "tetapi",
    "tapi", "sedangkan", "lalu", "kemudian", "maka", "jadi", "saja", "lagi", "terus", "pun",
    "baru", "pernah", "selalu", "sering", "kadang", "banyak", "beberapa", "semua", "setiap",
    "seluruh", "sebagian", "hal", "hari", "tahun", "bulan", "waktu", "orang", "saudara",
    "bapak", "ibu", "anak", "surabaya", "kota", "kecamatan", "jawa", "timur",
]

# Topic labels and the keywords that vote for them; the first label wins a tie.
TOPIC_KEYWORDS = {
    "Kriminalitas": [
        "begal", "polisi", "curanmor", "pelaku", "korban", "narkoba", "ditangkap", "pencurian",
        "sajam", "maling", "curas", "kriminal", "tersangka", "tahanan", "pidana",
    ],
    "Kesehatan": [
        "pasien", "dbd", "wabah", "diare", "nyamuk", "rsud", "puskesmas", "infeksi", "kesehatan",
        "kasus", "sakit", "medis", "rumah", "rawat", "penyakit",
    ],
}
CRIME_LABEL = "Kriminalitas"
HEALTH_LABEL = "Kesehatan"

# Words left out of a search phrase.
SEARCH_STOPWORDS = [
    "di", "dan", "ke", "dari", "yang", "untuk", "dengan", "pada", "oleh", "itu", "ini", "atau",
    "akibat", "guna",
]
SEARCH_URL_PREFIX = "https://news.google.com/search?q="
SEARCH_URL_SUFFIX = "&hl=id&gl=ID&ceid=ID:id"
CITY = "Surabaya"

# Place phrases in news text: street words, words that end a street name,
# landmark words in order of preference, sub-district words.
STREET_WORDS = ["jalan", r"jl\.?"]
STREET_END_WORDS = ["surabaya", "kecamatan", "kelurahan", "di", "dan", "yg", "yang", "pada", "dengan"]
LANDMARK_WORDS = ["pasar", "stasiun", "terminal", "rsud", "puskesmas", "pltsa", "kampung"]
SUBDISTRICT_WORDS = ["kelurahan", r"kel\.?"]

# Link parts of listing pages and of search pages.
LISTING_PARTS = ["/tag/", "/search", "/kategori/", "/topic/"]
SEARCH_PAGE_PARTS = ["news.google.com/search", "google.com/search"]
REDIRECT_PARTS = ["news.google.com/rss/articles/", "news.google.com/articles/"]

# Risk bands, highest first: (label, lower edge, edge belongs to the band).
RISK_LEVELS = [("EKSTRIM", 80.0, True), ("TINGGI", 60.0, True), ("SEDANG", 40.0, True),
               ("RENDAH", None, True)]
COLOUR_STEPS = [("4", 80.0, True), ("3", 60.0, True), ("2", 40.0, True), ("1", 20.0, True),
                ("0", None, True)]
COLOURS = {"4": "#C0392B", "3": "#E67E22", "2": "#F1C40F", "1": "#27AE60", "0": "#2ECC71"}
CRIME_ZONES = [("Ekstrim (>80)", 80.0, False), ("Tinggi (60-80)", 60.0, True),
               ("Sedang (40-60)", 40.0, True), ("Waspada (20-40)", 20.0, True),
               ("Aman (<20)", None, True)]
HEALTH_ZONES = [("Kritis (>75)", 75.0, False), ("Tinggi (50-75)", 50.0, True),
                ("Sedang (25-50)", 25.0, True), ("Rendah (<25)", None, True)]

# Advice printed in the risk report.
CRIME_ADVICE = [
    ("Tingkatkan patroli rutin dan pemasangan CCTV. Koordinasikan operasi gabungan dengan Polsek setempat.", 60.0, True),
    ("Perkuat sinergi RT/RW dan aparat. Pertimbangkan program Siskamling aktif.", 40.0, True),
    ("Pertahankan kondisi kondusif. Kembangkan program pemberdayaan masyarakat untuk pencegahan dini.", None, True),
]
HEALTH_ADVICE = [
    ("Prioritaskan penambahan tenaga kesehatan dan vaksinasi. Tingkatkan kapasitas Puskesmas.", 50.0, True),
    ("Lanjutkan program Posyandu dan monitoring berkala. Pantau tren kesehatan anak dan lansia.", None, True),
]
PRIORITY_CRIME = "Keamanan perlu penanganan lebih mendesak di wilayah ini."
PRIORITY_HEALTH = "Kesehatan perlu penanganan lebih mendesak di wilayah ini."

# Map defaults: centre point (lon, lat), jitter width and the city's bounding box.
DEFAULT_CENTRE = (112.7521, -7.2575)
JITTER_SPREAD = 0.012
BBOX = {"lat_min": -7.45, "lat_max": -7.15, "lon_min": 112.55, "lon_max": 112.90}

# District figures: lon, lat, area in km2, inhabitants per km2.
DISTRICT_FIGURES = {
    "tandes": (112.6789, -7.2605, 11.10, 14482),
    "kenjeran": (112.7844, -7.2211, 14.10, 14397),
    "asemrowo": (112.6953, -7.2348, 15.40, 6331),
    "semampir": (112.7601, -7.2114, 11.90, 29874),
    "jambangan": (112.7161, -7.3188, 8.60, 16919),
    "tenggilis mejoyo": (112.7667, -7.3175, 5.52, 22110),
    "tegalsari": (112.7388, -7.2661, 4.19, 52740),
    "gunung anyar": (112.7936, -7.3361, 9.70, 9907),
    "dukuh pakis": (112.6934, -7.2882, 9.90, 12455),
    "benowo": (112.6391, -7.2514, 23.73, 4064),
    "genteng": (112.7441, -7.2584, 4.04, 37152),
    "gayungan": (112.7247, -7.3323, 6.07, 11533),
    "mulyorejo": (112.7951, -7.2644, 14.20, 9834),
    "karang pilang": (112.6942, -7.3298, 9.20, 17321),
    "pabean cantian": (112.7369, -7.2183, 6.84, 25978),
    "pakal": (112.6105, -7.2356, 22.10, 4362),
    "sawahan": (112.7176, -7.2713, 6.93, 57921),
    "sukomanunggal": (112.6974, -7.2647, 9.20, 17748),
    "bulak": (112.7954, -7.2319, 7.30, 11000),
    "krembangan": (112.7214, -7.2289, 9.10, 25411),
    "wonokromo": (112.7383, -7.3005, 8.47, 26745),
    "sambikerep": (112.6514, -7.2833, 23.70, 6285),
    "simokerto": (112.7571, -7.2392, 2.59, 66793),
    "lakarsantri": (112.6464, -7.3114, 19.00, 6421),
    "rungkut": (112.7836, -7.3204, 21.10, 12089),
    "bubutan": (112.7303, -7.2471, 3.73, 38981),
    "tambaksari": (112.7674, -7.2526, 8.99, 38572),
    "wonocolo": (112.7356, -7.3142, 6.47, 16769),
    "gubeng": (112.7595, -7.2797, 7.99, 22041),
    "wiyung": (112.6908, -7.3044, 12.50, 10014),
    "sukolilo": (112.7961, -7.2997, 23.70, 8524),
}

# Crime baseline: district, cases, inhabitants, stated rate per 100 000, source picture.
BASELINE_YEAR = 2025
BASELINE_SOURCES = {1: "Crime_rate_1.png — Referensi Penelitian",
                    2: "Crime_rate_2.png — Referensi Penelitian"}
CRIME_BASELINE = [
    ("Karang Pilang", 77, 75503, 102.0, 1),
    ("Jambangan", 89, 54212, 164.2, 1),
    ("Gayungan", 50, 43846, 114.0, 1),
    ("Wonocolo", 15, 80034, 18.7, 1),
    ("Tenggilis Mejoyo", 89, 58932, 151.0, 1),
    ("Gunung Anyar", 92, 62342, 147.6, 1),
    ("Rungkut", 39, 123653, 31.5, 1),
    ("Sukolilo", 0, 115913, 0.0, 1),
    ("Mulyorejo", 100, 88214, 113.4, 1),
    ("Gubeng", 6, 132382, 4.5, 2),
    ("Wonokromo", 75, 153563, 48.8, 2),
    ("Dukuh Pakis", 75, 59345, 126.4, 2),
    ("Wiyung", 0, 76501, 0.0, 2),
    ("Lakarsantri", 23, 65013, 35.4, 2),
    ("Sambikerep", 33, 69076, 47.8, 2),
    ("Tandes", 175, 91784, 190.8, 2),
    ("Sukomanunggal", 82, 104166, 78.7, 2),
    ("Sawahan", 167, 198516, 84.1, 2),
    ("Tegalsari", 144, 97511, 147.6, 2),
    ("Genteng", 70, 58216, 120.3, 2),
    ("Tambaksari", 19, 97511, 19.5, 2),
    ("Kenjeran", 104, 58216, 178.6, 2),
    ("Bulak", 163, 227025, 71.8, 2),
    ("Simokerto", 71, 185294, 38.3, 2),
    ("Semampir", 78, 47839, 163.1, 2),
    ("Pabean Cantian", 71, 73931, 96.0, 2),
    ("Bubutan", 23, 96704, 23.8, 2),
    ("Krembangan", 72, 114866, 62.7, 2),
    ("Asemrowo", 84, 48841, 172.0, 2),
    ("Benowo", 92, 74933, 122.8, 2),
    ("Pakal", 61, 64515, 94.6, 2),
]

# City crime history: year, reported cases.
CITY_HISTORY = [(2019, 3377), (2020, 1647), (2021, 1648), (2022, 8759)]
