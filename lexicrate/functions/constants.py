"""Fixed values that must equal the reference's for equal results.

Kept as plain data, in their natural order.
"""

# English stop-word list (the 179 words of the standard NLTK list).
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his",
    "himself", "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the",
    "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re",
    "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn",
    "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma",
    "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]

# Country of origin -> region (unmapped values pass through).
REGION_MAP = {
    "American": "Western",
    "British": "Western",
    "Canadian": "Western",
    "Australian": "Western",
    "Bollywood": "South Asian",
    "Telugu": "South Asian",
    "Tamil": "South Asian",
    "Malayalam": "South Asian",
    "Bengali": "South Asian",
    "Kannada": "South Asian",
    "Marathi": "South Asian",
    "Punjabi": "South Asian",
    "Assamese": "South Asian",
    "Chinese": "East Asian",
    "Japanese": "East Asian",
    "South_Korean": "East Asian",
    "Hong Kong": "East Asian",
    "Filipino": "Southeast Asian",
    "Bangladeshi": "South Asian",
    "Russian": "European",
    "Turkish": "Middle Eastern",
    "Egyptian": "Middle Eastern",
    "Malaysian": "Southeast Asian",
}

# Built-in contraction lexicon.  Punctuation is deleted before expansion, so
# keys are written without apostrophes; only forms that are not also common
# words are listed.
CONTRACTIONS = {
    "aint": "are not", "arent": "are not", "cant": "cannot", "couldnt": "could not",
    "couldve": "could have", "didnt": "did not", "doesnt": "does not", "dont": "do not",
    "hadnt": "had not", "hasnt": "has not", "havent": "have not", "im": "i am",
    "isnt": "is not", "ive": "i have", "mightnt": "might not", "mustnt": "must not",
    "neednt": "need not", "shouldnt": "should not", "shouldve": "should have",
    "theyre": "they are", "theyve": "they have", "theyll": "they will", "wasnt": "was not",
    "werent": "were not", "weve": "we have", "wont": "will not", "wouldnt": "would not",
    "wouldve": "would have", "youre": "you are", "youve": "you have", "youll": "you will",
}
