"""Fixed word lists and patterns."""

# English stop words.
STOP_WORDS = """i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him
his himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re
ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't""".split()

# Extra stop words for mail.
MAIL_STOP_WORDS = ["subject", "http", "com", "email", "re"]

# Phrases after which the rest of a line is advertising.
SPAM_PHRASES = ["unsubscribe", "click here", "buy now", "special offer", "limited time", "free trial", "guaranteed"]

# Words that hint at spam.
TRIGGER_WORDS = ["free", "win", "winner", "money", "cash", "credit card", "viagra", "click", "subscribe"]

# Header lines that may be left in a body.
HEADER_LINES = ["Message-Id", "X-Loop", "Sender", "Errors-To"]

# Folder of a mail and its label.
CATEGORY_LABELS = {"easy_ham": 0, "easy_ham_2": 0, "hard_ham": 0, "spam": 1, "spam_2": 1}

# Wording of made advertising messages.
MESSAGE_TEMPLATES = [
    "Congratulations! You've won a {prize}. Claim your reward now at {fake_link}.",
    "Dear {name}, your account has been compromised. Reset your password here: {fake_link}",
    "Limited time offer! Get a {discount}% discount on {product}. Buy now at {fake_link}",
    "Earn {money} per week working from home! Sign up at {fake_link}",
    "Urgent: Your bank account requires verification! Log in here: {fake_link}",
    "Exclusive deal just for you, {name}! Click {fake_link} to get {offer}",
    "Act now! Get {cashback}% cashback on all purchases. Offer expires soon!",
    "You have an unclaimed reward of {reward_amount}. Claim it before it expires!",
    "Get a FREE trial of {service}. No credit card required. Sign up today!",
    "Don't miss this opportunity! Invest in {crypto} and double your money instantly!",
]

# What fills their slots; a pair of numbers is a range with both ends.
MESSAGE_SLOTS = {
    "name": ["John", "Jane", "Alex", "Chris"],
    "prize": ["$1,000", "a free iPhone", "a vacation to Hawaii"],
    "fake_link": ["http://scam.com", "http://fakepromo.com", "http://clickbait.com"],
    "discount": (10, 90),
    "product": ["a new laptop", "a premium membership", "a smart watch"],
    "money": (500, 5000),
    "offer": ["a VIP pass", "a free gift", "a limited-edition product"],
    "cashback": (5, 50),
    "reward_amount": ["$50", "$100", "a mystery gift"],
    "service": ["VPN", "streaming service", "cloud storage"],
    "crypto": ["Bitcoin", "Ethereum", "Dogecoin"],
}
