"""Naive Bayes over character n-grams of words: which language a text is in.

A word's log-likelihood is a sum over its n-grams, so it is computed once per distinct word and language and looked up
for every occurrence. Trained here on the sentences below; TRAINING may be replaced by a bounded labelled sample.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

# Training sentences, written for this library, of an office's everyday language.
TRAINING = {
    "pl": "Właściciel jest obowiązany zgłosić obiekt w terminie czternastu dni od dnia doręczenia decyzji. Za korzystanie z urządzenia pobiera się opłatę w wysokości określonej w przepisach. Bez zezwolenia nie wolno przebudować ani rozebrać obiektu. Jeżeli wniosek nie zawiera wymaganych dokumentów, organ wzywa do jego uzupełnienia. Urząd gminy przypomina, że termin upływa z końcem miesiąca. W przypadkach, o których mowa w ustawie, odwołanie składa się do wojewody. Czy można przenieść umowę na inną osobę? Tak, wystarczy złożyć oświadczenie i dowód wpłaty. Zgodnie z nowymi przepisami użytkownik gruntu powinien prowadzić rejestr. Przepraszam, ale nie jestem w stanie odpowiedzieć na to pytanie. Proszę zwrócić się do prawnika lub do właściwego urzędu. Nie, potrzebna jest zgoda współwłaścicieli, chyba że strony postanowiły inaczej. Mam dom i ogród, moja siostra idzie do szkoły, a brat łowi ryby. Wykładnia językowa uzasadnia dopuszczalność roszczenia, skoro zaś przepis ogranicza skuteczność czynności.",
    "en": "The owner must register the building within fourteen days of receiving the notice. A fee is charged for the use of the facility under the rules. Without a permit it is not allowed to rebuild or demolish it. If the application does not contain the required documents, the office will ask for them. Please note that the deadline expires at the end of the month. In the cases referred to in the act, an appeal may be lodged with the court. Can the contract be transferred to another person? Yes, it is enough to submit a statement and proof of payment. According to the new rules every user of the land has to keep a register. I am sorry, but I cannot answer this question. We would like to know whether they have already been there before.",
    "de": "Der Eigentümer muss das Gebäude innerhalb von vierzehn Tagen nach Zustellung des Bescheids anmelden. Für die Nutzung der Anlage wird eine Gebühr nach den Vorschriften erhoben. Ohne Genehmigung ist es nicht erlaubt, sie umzubauen oder abzureißen. Wenn der Antrag die erforderlichen Unterlagen nicht enthält, fordert die Behörde sie an. Bitte beachten Sie, dass die Frist am Ende des Monats abläuft. Wer das Grundstück nutzt, ist verpflichtet, ein Verzeichnis zu führen. Kann der Vertrag auf eine andere Person übertragen werden? Ja, es genügt eine Erklärung und ein Zahlungsnachweis. Es tut mir leid, aber diese Frage kann ich nicht beantworten. Die Gemeinde darf den Weg erst im Frühjahr schließen.",
    "cs": "Vlastník je povinen přihlásit stavbu do čtrnácti dnů ode dne doručení rozhodnutí. Za užívání zařízení se vybírá poplatek podle předpisů. Bez povolení není možné je přestavět ani zbourat. Pokud žádost neobsahuje požadované doklady, úřad vyzve k jejich doplnění. Upozorňujeme, že lhůta uplyne koncem měsíce. Kdo užívá pozemek, je povinen vést rejstřík. Je možné převést smlouvu na jinou osobu? Ano, stačí předložit prohlášení a doklad o zaplacení. Omlouvám se, ale na tuto otázku nemohu odpovědět. Podle nových pravidel může obec uzavřít cestu až na jaře, protože dosud nebyla zapsána. Potřebuje k tomu souhlas spoluvlastníků.",
    "sk": "Vlastník je povinný prihlásiť stavbu do štrnástich dní odo dňa doručenia rozhodnutia. Za užívanie zariadenia sa vyberá poplatok podľa predpisov. Bez povolenia nie je možné ju prestavať ani zbúrať. Ak žiadosť neobsahuje požadované doklady, úrad vyzve na ich doplnenie. Upozorňujeme, že lehota uplynie koncom mesiaca. Kto užíva pozemok, je povinný viesť register. Je možné previesť zmluvu na inú osobu? Áno, stačí predložiť vyhlásenie a doklad o zaplatení. Ospravedlňujem sa, ale na túto otázku nemôžem odpovedať. Podľa nových pravidiel môže obec uzavrieť cestu až na jar.",
    "uk": "Власник зобов'язаний зареєструвати будівлю протягом чотирнадцяти днів від дня отримання рішення. За користування спорудою сплачується збір згідно з правилами. Без дозволу не можна її перебудувати чи знести. Якщо заява не містить потрібних документів, орган вимагає їх доповнити. Хто користується ділянкою, повинен вести реєстр. Вибачте, але я не можу відповісти на це питання.",
    "ru": "Владелец обязан зарегистрировать здание в течение четырнадцати дней со дня получения решения. За пользование сооружением взимается сбор согласно правилам. Без разрешения нельзя его перестроить или снести. Если заявление не содержит необходимых документов, орган требует их дополнить. Кто пользуется участком, должен вести реестр. Извините, но я не могу ответить на этот вопрос.",
    "fr": "Le propriétaire doit déclarer le bâtiment dans les quatorze jours suivant la réception de la décision. Une taxe est perçue pour l'utilisation de l'installation selon les règles. Sans autorisation il est interdit de la reconstruire ou de la démolir. Si la demande ne contient pas les documents requis, l'autorité demande de la compléter. Celui qui utilise le terrain est tenu de tenir un registre. Je suis désolé, mais je ne peux pas répondre à cette question. Veuillez noter que le délai expire à la fin du mois.",
    "es": "El propietario debe registrar el edificio en un plazo de catorce días desde la recepción de la decisión. Por el uso de la instalación se cobra una tasa según las normas. Sin permiso no está permitido reconstruirla ni derribarla. Si la solicitud no contiene los documentos necesarios, la autoridad pide que se complete. Quien utiliza el terreno está obligado a llevar un registro. Lo siento, pero no puedo responder a esta pregunta.",
    "it": "Il proprietario deve registrare l'edificio entro quattordici giorni dal ricevimento della decisione. Per l'uso dell'impianto si paga una tassa secondo le norme. Senza autorizzazione non è permesso ricostruirlo o demolirlo. Se la domanda non contiene i documenti richiesti, l'ufficio chiede di completarla. Chi utilizza il terreno è tenuto a tenere un registro. Mi dispiace, ma non posso rispondere a questa domanda.",
    "lt": "Savininkas privalo įregistruoti pastatą per keturiolika dienų nuo sprendimo gavimo. Už naudojimąsi įrenginiu imamas mokestis pagal taisykles. Be leidimo negalima jo perstatyti ar nugriauti. Jeigu prašyme nėra reikalingų dokumentų, tarnyba prašo juos pateikti. Atsiprašau, bet negaliu atsakyti į šį klausimą.",
    "la": "Dominus aedificium intra quattuordecim dies post acceptam sententiam profiteri debet. Pro usu rei pretium secundum leges solvitur. Sine licentia id reficere aut diruere non licet. Mutatis mutandis, de lege lata, a contrario, ratio legis, in abstracto, pacta sunt servanda, lex retro non agit.",
}

ORDERS = (1, 2, 3, 4)
_WORD = re.compile(r"[^\W\d_]+")


def grams(word: str) -> list[str]:
    w = f" {word.lower()} "
    return [w[i : i + n] for n in ORDERS for i in range(len(w) - n + 1) if w[i : i + n] != " "]


class LanguageModel:
    """Posteriors of languages for words and texts."""

    def __init__(self, training: dict[str, str] | None = None, smooth: float = 0.5) -> None:
        training = training or TRAINING
        self.languages = list(training)
        counts = [Counter(g for w in _WORD.findall(t) for g in grams(w)) for t in training.values()]
        self.known = sorted(set().union(*counts))
        self.row = {g: k for k, g in enumerate(self.known)}
        table = np.array([[c[g] for c in counts] for g in self.known], float) + smooth
        lengths = np.array([len(g) for g in self.known])
        self.table = np.log(table)
        self.unseen = {}
        for n in ORDERS:  # one distribution for each order of n-grams
            own = lengths == n
            total = table[own].sum(axis=0) + smooth * 1000 * n
            self.table[own] -= np.log(total)
            self.unseen[n] = np.log(smooth / total)
        self._cache: dict[str, np.ndarray] = {}

    def word(self, w: str) -> np.ndarray:
        """Log-likelihood of a word in every language."""
        got = self._cache.get(w)
        if got is None:
            got = sum((self.table[self.row[g]] if g in self.row else self.unseen[len(g)] for g in grams(w)), np.zeros(len(self.languages)))
            if len(self._cache) < 1 << 18:
                self._cache[w] = got
        return got

    def scores(self, text: str) -> np.ndarray:
        found = _WORD.findall(text)
        return np.array([self.word(w) for w in found]).sum(axis=0) if found else np.zeros(len(self.languages))

    def language(self, text: str) -> str | None:
        """The likeliest language; None for a text without letters."""
        return self.languages[int(self.scores(text).argmax())] if _WORD.search(text) else None

    def posterior(self, text: str) -> dict[str, float]:
        s = self.scores(text)
        p = np.exp(s - s.max())
        return dict(zip(self.languages, p / p.sum(), strict=True))
