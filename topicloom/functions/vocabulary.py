"""The topic vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 177 topics, spelling included, in the published order.
TOPICS = [
    "3D", "Ajax", "Algorithm", "Amp", "Android", "Angular", "Ansible", "API", "Adruino",
    "ASP.NET", "Atom", "Awesome Lists", "Amazon Web Services", "Azure", "Babel", "Blockchain",
    "Bootstrap", "Bot", "C", "Chrome", "Chrome extension", "Command line interface", "Clojure",
    "Code quality", "Code review", "Compiler", "Coninuous integration", "C++", "Cryptocurrency",
    "Crystal", "C#", "CSS", "Data structures", "Data visualization", "Database", "Deep leaning",
    "Dependency management", "Deployment", "Django", "Docker", "Documentation", ".NET",
    "Electron", "Elixir", "Emacs", "Ember", "Emoji", "Emulator", "ES6", "ESLint", "Ethereum",
    "Express", "Firebase", "Firefox", "Flask", "Font", "Framework", "Front end", "Game engine",
    "Git", "GitHub API", "Go", "Google", "Gradle", "GraphQL", "Gulp", "Haskell", "Homebrew",
    "Homebridge", "HTML", "HTTP", "Icon font", "iOS", "IPFS", "Java", "Javascript", "Jekyll",
    "jQuery", "JSON", "The Julia Language", "Jupyter Notebook", "Koa", "Kotlin", "Kubernetes",
    "Laravel", "LaTex", "Library", "Linux", "Localization", "Lua", "Machine learning", "macOS",
    "Markdown", "Mastodon", "Material design", "MATLAB", "Maven", "Minecraft", "Mobile",
    "Monero", "MongoDB", "Mongoose", "Monitoring", "MvvmCross", "MySQL", "NativeScript", "Nim",
    "Natural language processing", "Node.js", "NoSQL", "npm", "Objective-C", "OpenGL",
    "Operating System", "P2P", "Package manager", "Language parsing", "Perl", "Perl 6",
    "Phaser", "PHP", "Pixel Art", "PostgreSQL", "Project management", "Publishing", "PWA",
    "Python", "Qt", "R", "Rails", "Raspberry Pi", "Ratchet", "React", "React Native",
    "ReactiveUI", "Redux", "REST API", "Ruby", "Rust", "Sass", "Scala", "scikit-learn",
    "Software-defined networking", "Security", "Server", "Serverless", "Shell", "Sketch",
    "SpaceVim", "Spring Boot", "SQL", "Storybook", "Support", "Swift", "Symfony", "Telegram",
    "Tensorflow", "Terminal", "Terraform", "Twitter", "Typescript", "Ubuntu", "Unity",
    "Unreal Engine", "Vagrant", "Vim", "Virtual Reality", "Vue.js", "Wagtail",
    "Web Components", "Web App", "Webpack", "Windows", "Wodplate", "Wordpress", "Xamarin",
    "XML",
]


def topic_vocabulary(spark: SparkSession) -> DataFrame:
    """The vocabulary as a table: ``topic_id bigint, topic string``."""
    entries = F.posexplode(F.lit(TOPICS)).alias("topic_id", "topic")
    return spark.range(1).select(entries).select(F.col("topic_id").cast("bigint"), "topic")
