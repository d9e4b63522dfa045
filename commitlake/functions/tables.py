"""Enumerations and lookup tables of the data model."""

# Kinds of datastores with their display names and further names (compared without case).
STORE_KINDS = {
    "Generic": ("Generic", []),
    "SmallProjects": ("Small", ["small"]),
    "C": ("C", []),
    "Cpp": ("C++", ["c++"]),
    "CSharp": ("C#", ["cs", "c#"]),
    "Clojure": ("Clojure", []),
    "CoffeeScript": ("CoffeeScript", []),
    "Erlang": ("Erlang", []),
    "Go": ("Go", []),
    "Haskell": ("Haskell", []),
    "Html": ("HTML", []),
    "Java": ("Java", []),
    "JavaScript": ("JavaScript", ["js"]),
    "ObjectiveC": ("ObjectiveC", ["objc", "objective-c"]),
    "Perl": ("Perl", []),
    "Php": ("PHP", []),
    "Python": ("Python", []),
    "Ruby": ("Ruby", []),
    "Scala": ("Scala", []),
    "Shell": ("Shell", []),
    "TypeScript": ("TypeScript", ["ts"]),
}

# Kinds of contents, in order, with the file endings that name them (with case).
CONTENTS_KINDS = {
    "Generic": [],
    "SmallFiles": [],
    "C": ["c", "h"],
    "Cpp": ["cpp", "cc", "cxx", "hpp", "C"],
    "CSharp": ["cs"],
    "Clojure": ["clj", "cljs", "cljc", "edn"],
    "CoffeeScript": ["coffee", "litcoffee"],
    "Erlang": ["erl", "hrl"],
    "Go": ["go"],
    "Haskell": ["hs", "lhs"],
    "Html": ["html", "htm"],
    "Java": ["java"],
    "JavaScript": ["js", "mjs"],
    "JSON": ["json"],
    "ObjectiveC": ["m", "mm", "M"],
    "Perl": ["plx", "pl", "pm", "xs", "t", "pod"],
    "Php": ["php", "phtml", "php3", "php4", "php5", "php7", "phps", "php-s", "pht", "phar"],
    "Python": ["py", "pyi", "pyc", "pyd", "pyo", "pyw", "pyz"],
    "Readme": ["README"],
    "Ruby": ["rb"],
    "Scala": ["scala", "sc"],
    "Shell": ["sh"],
    "TypeScript": ["ts", "tsx"],
}

# Languages of source files with their extensions; headers count for none.
LANGUAGES = {
    "C": ["c"],
    "C++": ["C", "cc", "cpp", "cxx", "c++"],
    "C#": ["cs"],
    "Objective-C": ["m", "mm", "M"],
    "Go": ["go"],
    "Java": ["java"],
    "Coffeescript": ["coffee", "litcoffee"],
    "Javascript": ["js", "mjs"],
    "Typescript": ["ts", "tsx"],
    "Ruby": ["rb"],
    "Php": ["php", "phtml", "php3", "php4", "php5", "php7", "phps", "php-s", "pht", "phar"],
    "Python": ["py", "pyi", "pyc", "pyd", "pyo", "pyw", "pyz"],
    "Perl": ["plx", "pl", "pm", "xs", "t", "pod"],
    "Clojure": ["clj", "cljs", "cljc", "edn"],
    "Erlang": ["erl", "hrl"],
    "Haskell": ["hs", "lhs"],
    "Scala": ["scala", "sc"],
}

# Words whose presence makes a commit message one of a bug fix.
BUG_WORDS = ["error", "bug", "fix", "issue", "mistake", "incorrect", "fault", "defect", "flaw"]

#: Bytes below which a file is a small one; commits below which a project is a small one; largest value in bytes.
SMALL_FILE, SMALL_PROJECT, LARGEST_VALUE = 100, 10, 10 * 1024**3

STORE_NUMBERS = {k: i for i, k in enumerate(STORE_KINDS)}
CONTENTS_NUMBERS = {k: i for i, k in enumerate(CONTENTS_KINDS)}
STORE_ALIASES = {name: kind for kind, (_, more) in STORE_KINDS.items() for name in [kind.lower(), *more]}
KIND_OF_ENDING = {e: k for k, v in CONTENTS_KINDS.items() for e in v}
LANGUAGE_OF_EXTENSION = {e: k for k, v in LANGUAGES.items() for e in v}

# Languages of the sampled projects, in lower case.
SAMPLED_LANGUAGES = [
    "c", "c++", "c#", "objective-c", "go", "java", "coffeescript", "javascript", "typescript", "ruby", "php", "python", "perl", "haskell", "scala",
]
