"""The default stop-word set of the inverted index.

It includes ``""``, ``'`` and ``_``, which the simple tokenizer lets through.
With the ASCII tokenizer, the entries holding accented letters can never match
(H7); they are kept so the set is the same as the original one. ``antecabe`` is a
typo in the original set and is kept too.
"""

# Fixed values (must equal the original job's set; 165 entries, natural order).
SPANISH_STOP_WORDS = (
    "", "'", "_", "a", "al", "ante", "antecabe", "aquella", "aquello", "aquí", "allí", "allá", "b", "c",
    "cabe", "cada", "como", "cómo", "con", "contra", "cual", "cuál", "cuando", "cuándo", "cuanto", "cuánto", "d", "de",
    "del", "decir", "dicen", "dicho", "desde", "después", "donde", "dónde", "durante", "e", "el", "él", "en", "entre",
    "es", "eso", "esto", "esa", "esta", "estar", "estoy", "ella", "ello", "ellos", "era", "estaba", "f", "fue", "g",
    "h", "haber", "ha", "he", "había", "hacer", "hago", "hacía", "hizo", "han", "has", "hacia", "hasta", "hay", "haz",
    "hubo", "i", "ir", "ido", "j", "k", "l", "la", "lo", "los", "las", "m", "mi", "mío", "más", "mas", "menos", "mismo",
    "misma", "mis", "mucho", "mucha", "muchos", "muchas", "muchísimo", "muchísimos", "muchísima", "muchísimas", "n",
    "no", "nosotros", "nuestro", "nos", "o", "os", "otro", "otra", "otros", "otras", "p", "para", "pero", "por", "q",
    "que", "qué", "quien", "quién", "r", "s", "sino", "suyo", "su", "ser", "se", "si", "sido", "sigo", "sus", "soy",
    "t", "tanto", "tanta", "tantos", "tantas", "tener", "tengo", "tenía", "todo", "todos", "toda", "todas", "tú", "tu",
    "tuyo", "tuya", "u", "un", "uno", "una", "unos", "unas", "v", "vosotros", "vosotras", "vuestro", "vuestra", "w",
    "x", "y", "ya", "yo", "z",
)


def stop_words_frame(spark, words=SPANISH_STOP_WORDS):
    """The set as a one-column DataFrame ``(word)``."""
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
