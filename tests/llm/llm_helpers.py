import random
import re


def shingle_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", ",", "."]) for _ in range(n))


WORDS = ["".join(random.Random(i).choices("abcdefghijklmnopé", k=1 + i % 9)) for i in range(400)]
EDGES = [None, "", " \n\t ", "one", "Two words", "a b c d", "a b c d e", "A B C D E", "word " * 3000, "x" * 200_000,
         "naïve café über 漢字 🙂 words and more", "\n\n\n\n", "l1\nl2\nl3\nl1\nl2\nl3"]
