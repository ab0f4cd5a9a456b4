"""Base figures and fertility against plain counting."""

import base64
import math
import random
import re
import string
from collections import Counter

import public_tokenizers
import regex
import sentencepiece

from strata.llm.quality_rules import BANDS, SCRIPTS, Band, QualityParams, quality_figures, script_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e f g h", "x y " * 40, "l1 a\nl2\nl1 a\n \n \nl2", "a\x1cb c\x85d",
         "Ein Haus # * & <b> %\r\nEin Haus", "été à la mer " * 3 + "fin", "да нет " * 12, "日本語のテキスト " * 20,
         " ".join(f"word{i}" for i in range(3000)), "a " * 20000, "\x00 \u2028 \u00a0 z", "q w e r t y u i o p a s d f g h j k l z"]


def test_figures_match_plain_counting(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], "clash"), (4, TEXTS[4], "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = quality_figures(docs, MODEL).collect()
    assert len(got) == len(rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = dict(enumerate(TEXTS)) | {None: TEXTS[4]}
    for r in got:
        text = texts[r.doc_id] or ""
        base = brute_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        ids = sp.encode(text)
        counts = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()) if ids else 0.0
        assert r.n_tokens == len(ids)
        assert math.isclose(r.token_entropy, entropy, abs_tol=1e-9)
        assert math.isclose(r.byte_share, sum(sp.is_byte(i) for i in ids) / max(1, len(ids)))
        assert not (r.base_failed and r.kept)
        assert r.kept == (r.reason is None)


def test_bands_reject_per_script(spark):
    prose = ("The quick brown fox jumps over a lazy dog while seven other animals watch from the nearby hill, and they all "
             "wonder what will happen next because nobody has ever seen such a strange thing before today.")
    docs = spark.createDataFrame([(1, prose), (2, " ".join("zq" * 9 + str(i) for i in range(30)))],
                                 "doc_id long, text string")
    loose = {r.doc_id: (r.kept, r.reason) for r in quality_figures(docs, MODEL).collect()}
    assert loose == {1: (True, None), 2: (False, "too few characters per token")}
    tight = QualityParams(bands={"Latin": Band(2.2, 9.0, 0.1, 2.0), "other": Band(0.1, 9.0, 1.0, 0.0)}, max_repeat_percent=100)
    got = {r.doc_id: (r.kept, r.reason) for r in quality_figures(docs, MODEL, tight).collect()}
    assert got[1] == (True, None)
    assert got[2] == (False, "too few characters per token")


# (script, language, text)
CLEAN = [
    ("Latin", "en",
     "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. The ferry leaves the harbour twice a day in winter, and most of the passengers are children on their way to school."),
    ("Latin", "fr",
     "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Le bateau quitte le port deux fois par jour en hiver."),
    ("Latin", "pl",
     "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Zimą prom wypływa z portu dwa razy dziennie."),
    ("Latin", "tr",
     "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Vapur kışın limandan günde iki kez kalkıyor."),
    ("Latin", "vi",
     "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình anh em."),
    ("Latin", "fi",
     "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Lautta lähtee satamasta talvella kahdesti päivässä."),
    ("Latin", "sw",
     "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu. Kivuko huondoka bandarini mara mbili kwa siku wakati wa baridi."),
    ("Latin", "yo",
     "Gbogbo ènìyàn ni a bí ní òmìnira; iyì àti ẹ̀tọ́ kọ̀ọ̀kan sì dọ́gba. Wọ́n ní ẹ̀bùn ti làákàyè àti ti ẹ̀rí-ọkàn, ó sì yẹ kí wọn ó máa hùwà sí ara wọn gẹ́gẹ́ bí ọmọ ìyá."),
    ("Cyrillic", "ru",
     "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Зимой паром отходит из порта два раза в день."),
    ("Cyrillic", "uk",
     "Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю і повинні діяти у відношенні один до одного в дусі братерства."),
    ("Cyrillic", "sr",
     "Сва људска бића рађају се слободна и једнака у достојанству и правима. Она су обдарена разумом и свешћу и треба једни према другима да поступају у духу братства."),
    ("Cyrillic", "kk",
     "Барлық адамдар тумысынан азат және қадір-қасиеті мен құқықтары тең болып дүниеге келеді. Адамдарға ақыл-парасат, ар-ождан берілген, сондықтан олар бір-бірімен туыстық, бауырмалдық қарым-қатынас жасаулары тиіс."),
    ("Cyrillic", "mn",
     "Хүн бүр төрж мэндлэхэд эрх чөлөөтэй, адилхан нэр төртэй, ижил эрхтэй байдаг. Оюун ухаан, нандин чанар заяасан хүн гэгч өөр хоорондоо ахан дүүгийн үзэл санаагаар харьцах учиртай."),
    ("Greek", "el",
     "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης. Το πλοίο φεύγει από το λιμάνι δύο φορές την ημέρα τον χειμώνα."),
    ("Arabic", "ar",
     "يولد جميع الناس أحراراً متساوين في الكرامة والحقوق. وقد وهبوا عقلاً وضميراً وعليهم أن يعامل بعضهم بعضاً بروح الإخاء. تغادر العبارة الميناء مرتين في اليوم في فصل الشتاء."),
    ("Arabic", "fa",
     "تمام افراد بشر آزاد به دنیا می‌آیند و از لحاظ حیثیت و حقوق با هم برابرند. همه دارای عقل و وجدان هستند و باید نسبت به یکدیگر با روح برادری رفتار کنند."),
    ("Hebrew", "he",
     "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה. המעבורת יוצאת מהנמל פעמיים ביום בחורף."),
    ("Devanagari", "hi",
     "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।"),
    ("Han", "zh",
     "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。冬天的时候，渡船每天两次离开港口，大部分乘客都是去上学的孩子。"),
    ("Han", "zht",
     "人人生而自由，在尊嚴和權利上一律平等。他們賦有理性和良心，並應以兄弟關係的精神相對待。冬天的時候，渡船每天兩次離開港口，大部分乘客都是去上學的孩子。"),
    ("Hiragana", "ja",
     "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。冬になると、船は一日に二回みなとを出ていきます。"),
    ("Katakana", "ja",
     "スベテノ ニンゲンハ ウマレナガラニシテ ジユウデアリ カツ ソンゲント ケンリトニ ツイテ ビョウドウデアル。コンピューター、インターネット、ソフトウェア、テレビ、ラジオ、レストラン、ホテル、タクシー。"),
    ("Hangul", "ko",
     "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다. 겨울에는 배가 하루에 두 번 항구를 떠난다."),
    ("Thai", "th",
     "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ ในฤดูหนาวเรือออกจากท่าวันละสองครั้ง"),
    ("other", "ka",
     "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. მათ მინიჭებული აქვთ გონება და სინდისი და ერთმანეთის მიმართ უნდა იქცეოდნენ ძმობის სულისკვეთებით."),
    ("other", "ta",
     "மனிதப் பிறிவியினர் சகலரும் சுதந்திரமாகவே பிறக்கின்றனர்; அவர்கள் மதிப்பிலும், உரிமைகளிலும் சமமானவர்கள், அவர்கள் நியாயத்தையும் மனச்சாட்சியையும் இயற்பண்பாகப் பெற்றவர்கள்."),
]


def noise():
    """(name, text) that no band may keep; 250 words each, drawn with a fixed seed."""
    draw = random.Random(10)

    def words(letters, n=250):
        return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(3, 9))) for _ in range(n))

    yield "lower", words(string.ascii_lowercase)
    yield "lower, English frequencies", words([c for c in CLEAN[0][2].lower() if c.isalpha()])
    yield "consonants", words("bcdfghjklmnpqrstvwxz")
    yield "letters and digits", words(string.ascii_letters + string.digits)
    yield "printable", words([chr(i) for i in range(33, 127)])
    yield "base64", " ".join(base64.b64encode(draw.randbytes(9)).decode() for _ in range(250))
    yield "Russian letters", words([chr(i) for i in range(0x430, 0x450)])
    for script in SCRIPTS[1:]:
        yield f"any {script}", words([chr(i) for i in range(0x10000) if regex.match(rf"(?V1)[\p{{Script={script}}}&&\p{{L}}]", chr(i))])
    for script, lang, text in CLEAN:
        if script != "Latin":
            yield f"mojibake of {lang}", text.encode().decode("latin-1").replace("\x85", ".").replace("\xa0", ".")


def test_bands_tell_noise_from_text_per_script(spark):
    assert set(SCRIPTS) < set(BANDS)
    clean, junk = {f"{s} {x}": t for s, x, t in CLEAN}, dict(noise())
    docs = spark.createDataFrame([*clean.items(), *junk.items()], "doc_id string, text string")
    # Scripts without spaces have few words; only the bands are asked here.
    got = {r.doc_id: r for r in quality_figures(docs, MODEL, QualityParams(min_words=1, max_repeat_percent=100)).collect()}
    assert {x: got[x].script for x in clean} == {f"{s} {x}": s for s, x, _ in CLEAN}
    assert {x: got[x].reason for x in clean if not got[x].kept} == {}
    assert [x for x in junk if got[x].kept] == []


def rich_in_marks():
    """(name, text): tables, references, code, logs and lists as they stand in clean documents."""
    draw = random.Random(3)
    n = draw.randrange
    states = "Alabama Alaska Arizona Arkansas California Colorado Connecticut Delaware Florida Georgia Hawaii Idaho Illinois Indiana Iowa".split()
    yield "census table", "\n".join(f"{s}\t{n(10 ** 3, 10 ** 6)}\t{n(10 ** 3, 10 ** 6)}\t{n(1000) / 10}\t{n(10000) / 100}" for s in states)
    papers = [("Knuth, D. E.", "The art of computer programming"), ("Codd, E. F.", "A relational model of data for large shared data banks"),
              ("Gray, J. N.", "Notes on data base operating systems"), ("Dijkstra, E. W.", "Self-stabilizing systems")]
    yield "references", "\n".join(f"[{i}] {a} ({n(1960, 2024)}). {t}. Commun. ACM, {n(1, 90)}({n(1, 12)}), {n(1, 900)}-{n(901, 999)}. doi:10.{n(1000, 9999)}/{n(10 ** 6)}"
                                  for i, (a, t) in enumerate(papers * 2))
    yield "citations", ("Smith J, Jones AB, Li X. N Engl J Med 2019;381:1456-65. PMID 31597020. Doe RT, Roe KL. Lancet 2020;395:497-506. Ann Intern Med "
                        "2018;169:467-73. JAMA 2017;318(2):1243-52. BMJ 2016;354:i4482. Nature 2015;521:436-44. Science 2014;346:1258096.")
    yield "C code", ("#include <stdio.h>\nint main(int argc, char **argv) {\n  for (int i = 0; i < argc; ++i) {\n    if (argv[i][0] == '-') continue;\n"
                     "    printf(\"%s\\n\", argv[i]);\n  }\n  return 0;\n}\nstatic inline uint32_t rotl(uint32_t x, int8_t r) { return (x << r) | (x >> (32 - r)); }\n")
    yield "assembly", "mov eax, 1\nxor ebx, ebx\nint 0x80\npush ebp\nmov ebp, esp\nsub esp, 0x10\nlea eax, [ebp-0x8]\ncall 0x8048400\nadd esp, 0x10\nleave\nret\n"
    yield "access log", "\n".join(f"2024-01-{n(10, 30)}T{n(10, 24)}:{n(10, 60)}:{n(10, 60)}Z 10.0.{n(256)}.{n(256)} GET /api/v1/items/{n(10 ** 5)} "
                                  f"{draw.choice((200, 404, 500))} {n(10, 3000)}ms" for _ in range(30))
    yield "price list", "\n".join(f"{draw.choice(('Apples', 'Pears', 'Plums', 'Bread', 'Milk 3.5%', 'Butter'))} ${n(900) / 100} / {draw.choice(('kg', 'lb', 'each'))}" for _ in range(30))
    yield "results", "\n".join(f"{n(1, 29)} {draw.choice(('Jan', 'Feb', 'Mar'))} 2023 18:{n(10, 60)} {draw.choice(('Leeds', 'Lyon', 'Porto'))} - "
                               f"{draw.choice(('Ajax', 'Roma', 'Celtic'))} {n(5)}:{n(5)}" for _ in range(20))
    yield "JSON records", "\n".join(f'{{"id": {n(9999)}, "name": "{draw.choice(("bolt", "nut", "gear", "shaft"))}", "price": {n(5000) / 100}}}' for _ in range(20))
    yield "table of contents", "\n".join(f"{i}.{j} {draw.choice(('Introduction', 'Related work', 'Method', 'Results'))} ........ {10 * i + j}" for i in range(1, 8) for j in range(1, 5))
    yield "numbers", " ".join(str(n(10 ** 6)) for _ in range(100))
    yield "Russian table", "\n".join(f"{c}\t{n(10 ** 6)}\t{n(10 ** 6)}" for c in "Москва Казань Самара Омск Пермь Уфа Тула Псков Тверь Орёл".split() * 2)


def test_tables_references_code_and_lists_are_kept(spark):
    clean = dict(rich_in_marks())
    draw = random.Random(4)
    junk = {"hex": " ".join("".join(draw.choice("0123456789abcdef") for _ in range(32)) for _ in range(40)),
            "base64 and marks": " ".join(base64.b64encode(draw.randbytes(9)).decode() + "+/=#;" for _ in range(250)),
            "printable": " ".join("".join(chr(draw.randrange(33, 127)) for _ in range(8)) for _ in range(250))}
    docs = spark.createDataFrame([*clean.items(), *junk.items()], "doc_id string, text string")
    got = {r.doc_id: r for r in quality_figures(docs, MODEL, QualityParams(max_repeat_percent=100)).collect()}
    assert {x: (got[x].reason, got[x].chars_per_token) for x in clean if not got[x].kept} == {}
    assert [x for x in junk if got[x].kept] == []


def test_evenly_drawn_tokens_have_too_much_entropy(spark):
    sp, draw = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(11)
    whole = [p[1:] for p in map(sp.id_to_piece, range(sp.get_piece_size())) if re.fullmatch("▁[a-z]{4,}", p)]
    docs = spark.createDataFrame([(1, " ".join(draw.sample(whole, 2000)))], "doc_id long, text string")
    assert [r.reason for r in quality_figures(docs, MODEL).collect()] == ["too much token entropy"]


def test_scripts():
    assert script_of("plain") == "Latin" and script_of("été") == "Latin" and script_of("") == "Latin"
    assert script_of("привет мир x") == "Cyrillic" and script_of("日本語") == "Han" and script_of("αβγ") == "Greek"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_figures(docs, MODEL).collect() == []
