"""Likely language of a text: by its letters, by function words, and by profiles of character trigrams.

Vietnamese shows itself by its letters and other scripts by their names. Of
languages that share the Latin script, function words tell where they are many;
else trigrams of the words are scored against a profile of each language.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache

# Frequent function words by language. Vietnamese shows itself by its letters.
FUNCTION_WORDS = {
    "en": "the a an of and to in is for that with by on or which not must shall may should if this be are from has have will when than as it at before after within without each can needs",
    "fr": "le la les un une des du de et à au aux en est pour que qui dans par sur ou ne pas ce cette doit sont avec se son sa si leur avant sous lors puis",
    "id": "yang dan di ke dari untuk pada dengan tidak dapat ini itu oleh atau akan adalah dalam bagi harus ketika jika sebelum setelah boleh para karena agar sampai",
    "es": "el la los las un una de del y en es para que con por no se debe al su o como si antes lo son este esta cuando",
    "de": "der die das und ein eine ist für mit von den dem des nicht zu auf wird oder im bei muss nach vor wenn als sich",
    "pt": "o a os as um uma de do da e em é para que com por não se deve ao seu ou como quando antes no na",
    "it": "il lo la i gli le un una di del della dei e in è per che con da non si deve al alla o come quando prima sono nel nella questo",
    "nl": "de het een van en in is voor dat met op niet te door of als naar bij aan wordt moet zijn deze na wanneer",
    "sv": "en ett och i är för att med på som inte av till eller om från den det de skall ska före efter när",
    "pl": "i w na z do nie się jest że o od po przez dla lub oraz jak który która przed gdy ma być tym",
    "tr": "ve bir bu için ile olarak değil da de veya gibi sonra önce olan her ise kadar",
    "ro": "și în de la cu un o este pentru că nu pe din sau care se al a prin după înainte trebuie",
}

# Articles 1 and 3 to 5 of the Universal Declaration of Human Rights, from which the profiles are made.
SAMPLES = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone has the right to life, liberty and the security of person. No one shall be held in slavery or servitude; slavery and the slave trade shall be prohibited in all their forms. No one shall be subjected to torture or to cruel, inhuman or degrading treatment or punishment.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne. Nul ne sera tenu en esclavage ni en servitude; l'esclavage et la traite des esclaves sont interdits sous toutes leurs formes. Nul ne sera soumis à la torture, ni à des peines ou traitements cruels, inhumains ou dégradants.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. Todo individuo tiene derecho a la vida, a la libertad y a la seguridad de su persona. Nadie estará sometido a esclavitud ni a servidumbre; la esclavitud y la trata de esclavos están prohibidas en todas sus formas. Nadie será sometido a torturas ni a penas o tratos crueles, inhumanos o degradantes.",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade. Todo o indivíduo tem direito à vida, à liberdade e à segurança pessoal. Ninguém será mantido em escravatura ou em servidão; a escravatura e o trato dos escravos, sob todas as formas, são proibidos. Ninguém será submetido a tortura nem a penas ou tratamentos cruéis, desumanos ou degradantes.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. Ogni individuo ha diritto alla vita, alla libertà ed alla sicurezza della propria persona. Nessun individuo potrà essere tenuto in stato di schiavitù o di servitù; la schiavitù e la tratta degli schiavi saranno proibite sotto qualsiasi forma. Nessun individuo potrà essere sottoposto a tortura o a trattamento o a punizione crudeli, inumani o degradanti.",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geiste der Brüderlichkeit begegnen. Jeder hat das Recht auf Leben, Freiheit und Sicherheit der Person. Niemand darf in Sklaverei oder Leibeigenschaft gehalten werden; Sklaverei und Sklavenhandel in allen ihren Formen sind verboten. Niemand darf der Folter oder grausamer, unmenschlicher oder erniedrigender Behandlung oder Strafe unterworfen werden.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen. Een ieder heeft het recht op leven, vrijheid en onschendbaarheid van zijn persoon. Niemand zal in slavernij of horigheid gehouden worden. Slavernij en slavenhandel in iedere vorm zijn verboden. Niemand zal onderworpen worden aan folteringen, noch aan een wrede, onmenselijke of onterende behandeling of bestraffing.",
    "id": "Semua orang dilahirkan merdeka dan mempunyai martabat dan hak-hak yang sama. Mereka dikaruniai akal dan hati nurani dan hendaknya bergaul satu sama lain dalam semangat persaudaraan. Setiap orang berhak atas kehidupan, kebebasan dan keselamatan sebagai individu. Tidak seorang pun boleh diperbudak atau diperhambakan; perbudakan dan perdagangan budak dalam bentuk apa pun mesti dilarang. Tidak seorang pun boleh disiksa atau diperlakukan secara kejam, diperlakukan atau dihukum secara tidak manusiawi atau dihina.",
    "sv": "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete och bör handla gentemot varandra i en anda av broderskap. Var och en har rätt till liv, frihet och personlig säkerhet. Ingen får hållas i slaveri eller träldom; slaveri och slavhandel i alla dess former skall vara förbjudna. Ingen får utsättas för tortyr eller grym, omänsklig eller förnedrande behandling eller bestraffning.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek ma prawo do życia, wolności i bezpieczeństwa swej osoby. Nie wolno nikogo czynić niewolnikiem ani nakładać na nikogo służebności; niewolnictwo i handel niewolnikami są zakazane we wszystkich swych postaciach. Nie wolno nikogo torturować ani karać lub traktować w sposób okrutny, nieludzki lub poniżający.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Yaşamak, hürriyet ve kişi emniyeti her ferdin hakkıdır. Hiç kimse kölelik veya kulluk altında bulundurulamaz; kölelik ve köle ticareti her türlü şekliyle yasaktır. Hiç kimse işkenceye, zalimane, gayriinsani, haysiyet kırıcı cezalara veya muamelelere tabi tutulamaz.",
    "ro": "Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință și trebuie să se comporte unele față de altele în spiritul fraternității. Orice ființă umană are dreptul la viață, la libertate și la securitatea persoanei sale. Nimeni nu va fi ținut în sclavie, nici în servitute; sclavajul și comerțul cu sclavi sunt interzise sub toate formele lor. Nimeni nu va fi supus torturii, nici la pedepse sau tratamente crude, inumane sau degradante.",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình anh em. Mọi người đều có quyền sống, quyền tự do và an toàn cá nhân. Không ai bị bắt làm nô lệ hoặc bị cưỡng bức làm việc như nô lệ; mọi hình thức nô lệ và buôn bán nô lệ đều bị cấm. Không ai bị tra tấn hay bị đối xử, xử phạt một cách tàn bạo, vô nhân đạo hoặc hạ thấp nhân phẩm.",
}
LANGUAGES = list(SAMPLES)

#: Least lead over the second language, in natural logarithms: over the whole text, and for each of its words. Short texts lack the first by themselves.
LEAD, LEAD_A_WORD = 5.0, 0.4
#: What a function word adds to its language, in natural logarithms.
FUNCTION_WORD = 2.0

_VI_LETTERS = "ăắằẳẵặấầẩẫậđẻẽẹếềểễệỉĩịỏọốồổỗộơớờởỡợủũụưứừửữựỳỷỹỵ"
_viet = re.compile(f"[{_VI_LETTERS}]")
_beyond_latin = re.compile(r"[^\W\d_\u0000-ɏḀ-ỿ]")
_nonword = re.compile(r"[\W_]+")

_LANGUAGES_OF: dict[str, list[str]] = {}
for _name, _listed in FUNCTION_WORDS.items():
    for _w in _listed.split():
        _LANGUAGES_OF.setdefault(_w, []).append(_name)


def plain_words(text: str) -> str:
    """Lower-case letters and digits in composed form, with single spaces between and around, apostrophes closed up."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return f" {_nonword.sub(' ', text.lower().replace(chr(39), '').replace(chr(0x2019), '')).strip()} "


def _bare(text: str) -> str:
    """Without accents, as Vietnamese is often typed."""
    return "".join(c for c in unicodedata.normalize("NFD", text.replace("đ", "d")) if unicodedata.category(c) != "Mn")


@lru_cache(1)
def profiles() -> dict[str, tuple[float, ...]]:
    """Trigram of a word with a space at either end -> its logarithmic probability in each language; "" for all others."""
    counts = []
    for name in LANGUAGES:
        text = plain_words(SAMPLES[name]) + (_bare(plain_words(SAMPLES[name])) if name == "vi" else "")
        words = text.split() + FUNCTION_WORDS.get(name, "").split() * 2
        counts.append(Counter(f" {w} "[i : i + 3] for w in words for i in range(len(w))))
    known = set().union(*counts)
    totals = [sum(c.values()) + 0.5 * (len(known) + 1) for c in counts]
    table = {g: tuple(math.log((c[g] + 0.5) / t) for c, t in zip(counts, totals)) for g in known}
    table[""] = tuple(math.log(0.5 / t) for t in totals)
    return table


@lru_cache(200_000)
def _word_scores(word: str) -> tuple[float, ...]:
    table = profiles()
    found = [table.get(f" {word} "[i : i + 3], table[""]) for i in range(len(word))]
    return tuple(map(sum, zip(*found)))


def by_profiles(parts: list[str], function_words: dict[str, int]) -> str | None:
    """The language that trigrams and function words together make most likely, if it leads the next by ``LEAD`` and for each word by ``LEAD_A_WORD``."""
    words = [w for w in parts if not w.isdigit()]
    if not words:
        return None
    totals = [t + FUNCTION_WORD * function_words.get(name, 0) for name, t in zip(LANGUAGES, map(sum, zip(*map(_word_scores, words))))]
    best, second = sorted(totals, reverse=True)[:2]
    if best - second < max(LEAD, LEAD_A_WORD * len(words)):
        return None
    return LANGUAGES[totals.index(best)]


def language(words: str) -> str | None:
    """Likely language of text made by ``plain_words``, or None where too little speaks for any."""
    parts = words.split()
    if not parts:
        return None
    if (own := len(_viet.findall(words))) >= 2 and own * 4 >= len(parts):
        return "vi"
    if not words.isascii() and len(others := _beyond_latin.findall(words)) * 3 > len(words) - len(parts):
        names = [unicodedata.name(ch, "?").split(" ")[0] for ch in others]
        return max(set(names), key=lambda n: (names.count(n), n))
    counts: dict[str, int] = {}
    for w in parts:
        for name in _LANGUAGES_OF.get(w, ()):
            counts[name] = counts.get(name, 0) + 1
    ranked = sorted(counts.values(), reverse=True)
    # many function words, and clearly more than of any other language
    if len(parts) >= 4 and ranked and ranked[0] >= 2 and ranked[0] * 6 >= len(parts) and (len(ranked) == 1 or ranked[0] >= 2 * ranked[1]):
        return max(counts, key=lambda n: (counts[n], n))
    return by_profiles(parts, counts)
