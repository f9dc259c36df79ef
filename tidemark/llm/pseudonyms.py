"""Format-preserving Feistel pseudonyms for personal data, with DataFrame functions only.

Validated values are permuted by a key within their own format: a card number becomes another number that
passes the same checksum, a date another date. The permutation is a bijection, so equal values stay equal
across documents and different values stay different. Digits keep their place between separators, so one
number written in two ways stays one number.

Kinds: e-mail addresses (their local part), IPv4 addresses, payment cards (Luhn), social security numbers
(assigned ranges), phone numbers, dates (calendar, 1900 to 2099), and credentials (access keys, ``password=``
and ``token =`` values). Anything that fails its kind's check is left as it is.

Digits beside a value never hide it. E-mail addresses and credentials are taken first. Then come card numbers in their usual
groups: of all places where such a form begins, overlapping ones too, those whose number passes Luhn. Then
dates, social security numbers, addresses and phone numbers, and last runs of 13 to 19 digits with any single separators,
which count as cards where the whole run passes Luhn.

Defined results: null stays null, empty stays empty, text without such values stays byte for byte. Repeated
rows and ties are treated alike. Other columns pass through untouched, clashing names included. An empty
table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import carry

ROUNDS = 8  # even, so that both halves end where they began
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The written form of each kind. The order matters where forms overlap.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@(?:[A-Za-z0-9\-]{1,63}\.){1,9}[A-Za-z]{2,24}",
    "credential": (r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
                   r"|(?<=\bpassword=)[^\s\"',;]{4,64}"
                   r"|(?<=\btoken = \")[^\s\"]{8,64}(?=\")"),
    "date": r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/\-]|\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])",
    "phone": (r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[ .\-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])"
              r"[0-9]{3}[ .\-][0-9]{4}(?![0-9])"),
}
#: Groups that cards are printed in, or none. Only one of them can begin at a place.
CARD_GROUPS = (r"(?<![0-9])(?:[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5}|[0-9]{4}(?:[ \-][0-9]{3}){3}"
               r"|[0-9]{13,19})(?![0-9])")
ANY_FORM = "|".join(f"(?:{form})" for form in FORMS.values())
#: Every form needs one of these, so most texts are passed over by a plain scan.
HINT = r"[0-9@]|AKIA|ASIA|password=|token = "
_FIRST_DAY, _DAYS_A, _DAYS_B = "1900-01-01", 17, 4297  # 17 * 4297 days reach 2099-12-31


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(key: str, *parts: Column) -> Column:
    """A keyed number below 2^60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute_pair(key: str, left: Column, right: Column, n_left: int, n_right: int) -> Column:
    """A bijection on pairs (0..n_left-1, 0..n_right-1): each half in turn moves by a keyed amount of the other."""
    def step(s: Column, r: Column) -> Column:
        moved = (s["a"] + _number(key, F.lit("L"), r, s["b"])) % F.lit(n_left)
        return F.struct(
            moved.alias("a"),
            ((s["b"] + _number(key, F.lit("R"), r, moved)) % F.lit(n_right)).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)),
                       F.struct(left.cast("long").alias("a"), right.cast("long").alias("b")), step)


def _shifted(char: Column, by: Column) -> Column:
    """The character moved within its own class; signs stay."""
    def within(alphabet: str) -> Column:
        place = (F.instr(F.lit(alphabet), char) - 1 + by) % F.lit(len(alphabet)) + 1
        return F.lit(alphabet).substr(place.cast("int"), F.lit(1))

    return (F.when(char.between("0", "9"), within(_DIGITS))
            .when(char.between("a", "z"), within(_LOWER))
            .when(char.between("A", "Z"), within(_UPPER)).otherwise(char))


def permute_characters(key: str, text: Column) -> Column:
    """A bijection on strings of the same length and classes of characters."""
    def step(s: Column, r: Column) -> Column:
        def moved(digest: Column) -> Column:
            return F.array_join(F.transform(
                F.filter(F.split(s["a"], ""), lambda c: c != ""),
                lambda c, i: _shifted(c, F.conv(digest.substr((i * 3) % 60 + 1, F.lit(4)), 16, 10).cast("long"))), "")

        return F.struct(s["b"].alias("a"),
                        _let(F.sha2(F.concat_ws("|", F.lit(key), r.cast("string"), s["b"]), 256), moved).alias("b"))

    half = (F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"),
                     text.substr(half + 1, F.length(text)).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """The digits put in the places of the digits of ``form``, from the last one backwards.

    Both are reversed, since the number of digits left of a place may differ from one form to another
    (a country code), while what follows is alike.
    """
    def place(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(form, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), digits.substr(nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(form, ""), lambda c: c != ""), place), "")


def luhn_sum(digits: Column) -> Column:
    """The checksum total of a digit string, its last digit being the check digit."""
    def add(total: Column, d: Column) -> Column:
        doubled = d["v"] * 2
        return total + F.when(d["i"] % 2 == 0, d["v"]).when(doubled > 9, doubled - 9).otherwise(doubled)

    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                         lambda c, i: F.struct(c.cast("int").alias("v"), i.alias("i")))
    return F.aggregate(values, F.lit(0), add)


def _card(key: str, value: Column) -> Column:
    """The first digit, which names the network, stays; the check digit is computed anew."""
    def build(digits: Column) -> Column:
        payload = F.concat(F.substring(digits, 1, 1),
                           permute_characters(key + "card", digits.substr(F.lit(2), F.length(digits) - 2)))
        def checked(p: Column) -> Column:
            return F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string"))

        return F.when(luhn_sum(digits) % 10 == 0, _refill(value, _let(payload, checked))).otherwise(value)

    return _let(_digits(value), build)


def _phone(key: str, value: Column) -> Column:
    """The last ten digits are permuted but for the first of them; a country code stays."""
    def build(digits: Column) -> Column:
        n = F.length(digits)
        return _refill(value, F.concat(
            F.substring(digits, F.lit(1), n - 9),
            permute_characters(key + "phone", digits.substr(n - 8, F.lit(9)))))

    return _let(_digits(value), build)


def _ssn(key: str, value: Column) -> Column:
    area, group, serial = (F.substring(value, *x).cast("int") for x in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    # Areas 1..899 without 666 are 0..897; group and serial together are 99 * 9999 values.
    a = F.when(area > 666, area - 2).otherwise(area - 1)
    b = (group - 1) * 9999 + serial - 1

    def written(p: Column) -> Column:
        back = F.when(p["a"] >= 665, p["a"] + 2).otherwise(p["a"] + 1)
        return F.concat_ws("-", F.lpad(back.cast("string"), 3, "0"),
                           F.lpad((F.floor(p["b"] / 9999) + 1).cast("string"), 2, "0"),
                           F.lpad((p["b"] % 9999 + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(permute_pair(key + "ssn", a, b, 898, 99 * 9999), written)).otherwise(value)


def _ip(key: str, value: Column) -> Column:
    def build(parts: Column) -> Column:
        octet = [F.get(parts, i).cast("int") for i in range(4)]
        valid = F.forall(parts, lambda p: p.cast("int") <= 255)
        pair = permute_pair(key + "ip", octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536)

        def written(p: Column) -> Column:
            return F.concat_ws(".", *[x.cast("string") for x in (
                F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)])

        return F.when(valid, _let(pair, written)).otherwise(value)

    return _let(F.split(value, r"\."), build)


def _date(key: str, value: Column) -> Column:
    """ISO or slashed dates; a slashed one is month first where that is a date, else day first."""
    pattern = (F.when(F.instr(value, "-") > 0, F.lit("yyyy-MM-dd"))
               .when(F.try_to_timestamp(value, F.lit("MM/dd/yyyy")).isNotNull(), F.lit("MM/dd/yyyy"))
               .otherwise(F.lit("dd/MM/yyyy")))
    day = F.datediff(F.coalesce(*[F.try_to_timestamp(value, F.lit(p)).cast("date")
                                  for p in ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")]),
                     F.lit(_FIRST_DAY).cast("date"))

    def build(n: Column) -> Column:
        def written(p: Column) -> Column:
            date = F.date_add(F.lit(_FIRST_DAY).cast("date"), (p["a"] * _DAYS_B + p["b"]).cast("int"))
            return (F.when(pattern == "yyyy-MM-dd", F.date_format(date, "yyyy-MM-dd"))
                    .when(pattern == "MM/dd/yyyy", F.date_format(date, "MM/dd/yyyy"))
                    .otherwise(F.date_format(date, "dd/MM/yyyy")))

        pair = permute_pair(key + "date", F.floor(n / _DAYS_B), n % _DAYS_B, _DAYS_A, _DAYS_B)
        return F.when(n.between(0, _DAYS_A * _DAYS_B - 1), _let(pair, written)).otherwise(value)

    return _let(day, build)


def _email(key: str, value: Column) -> Column:
    """The local part is permuted; the host, which many share, stays."""
    return F.concat(permute_characters(key + "email", F.substring_index(value, "@", 1)), F.lit("@"),
                    F.substring_index(value, "@", -1))


def _credential(key: str, value: Column) -> Column:
    prefix = F.regexp_extract(value, "^(AKIA|ASIA)?", 0)
    return F.concat(prefix, permute_characters(
        key + "credential", value.substr(F.length(prefix) + 1, F.length(value))))


def pseudonym(key: str, value: Column, kinds: tuple[str, ...] = tuple(FORMS)) -> Column:
    """The pseudonym of one found value of some kinds, by the first form that it has in full."""
    makers = {"email": _email, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone,
              "credential": _credential}
    ordered = [k for k in makers if k in kinds]
    found = None
    for kind in ordered[:-1]:
        has = value.rlike(f"^(?:{FORMS[kind]})$")
        found = F.when(has, makers[kind](key, value)) if found is None else found.when(has, makers[kind](key, value))
    last = makers[ordered[-1]](key, value)
    return last if found is None else found.otherwise(last)


def _replaced(text: Column, form: Column, make, rest) -> Column:
    """``make`` of what has the form and ``rest`` of the pieces between, put together in order: nothing else can change."""
    def rebuilt(found: Column) -> Column:
        pieces = F.transform(F.split(text, form, -1), rest)
        changed = F.concat(F.transform(found, make), F.array(F.lit("")))
        return F.array_join(F.zip_with(pieces, changed, lambda p, v: F.concat(p, v)), "")

    return _let(F.regexp_extract_all(text, form, F.lit(0)), rebuilt)


def _any_of(*kinds: str) -> Column:
    return F.lit("|".join(f"(?:{FORMS[k]})" for k in kinds))


def _without_cards(key: str, text: Column) -> Column:
    kinds = ("date", "ssn", "ip", "phone")
    return _replaced(text, _any_of(*kinds), lambda v: pseudonym(key, v, kinds),
                     lambda p: _replaced(p, _any_of("card"), lambda v: _card(key, v), lambda q: q))


def _numbers(key: str, text: Column) -> Column:
    """A text without addresses and credentials: valid cards first, then what stands between them."""
    def cards(valid: Column) -> Column:
        # (?!) matches nowhere, for texts without a valid card.
        form = F.concat(F.lit("(?<![0-9])(?:"), F.array_join(F.concat(valid, F.array(F.lit("(?!)"))), "|"), F.lit(")(?![0-9])"))
        return _replaced(text, form, lambda v: _card(key, v), lambda p: _without_cards(key, p))

    # A match of no length lets the next one begin inside the number that it has looked at.
    begun = F.regexp_extract_all(text, F.lit(f"(?=({CARD_GROUPS}))"), F.lit(1))
    return _let(F.filter(begun, lambda v: _let(_digits(v), luhn_sum) % 10 == 0), cards)


def replace_personal_data(frame: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The frame with the values in its text column replaced. All other columns stay as they are.

    Texts without a value skip the work.
    """
    inner, names = carry(frame)
    column = F.col(f"_in{names.index(text)}")
    named = ("email", "credential")
    new = F.when(column.rlike(HINT) & column.rlike(ANY_FORM), _replaced(
        column, _any_of(*named), lambda v: pseudonym(key, v, named), lambda p: _numbers(key, p))).otherwise(column)
    return inner.withColumn(f"_in{names.index(text)}", new).toDF(*names)
