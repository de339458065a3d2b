"""Fixed values.

Everything in the FIXED VALUES block must stay byte-identical to the
surveyed corpus tooling, because prompts, requests and falsified dates are
compared as text.  Everything below that block is our own choice.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the surveyed tooling; keep text and order as is)
# ---------------------------------------------------------------------------

MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# range of a falsified year, both ends included
FALSE_YEAR_MIN = 1850
FALSE_YEAR_MAX = 2023

EOS = "</s>"

PLAIN_HEAD = (
    "Below is a Question that needs to be answered. Write a response that "
    "answers the question to the best of your abilities.\n"
)

GEMMA_USER = "<start_of_turn>user"
GEMMA_MODEL = "<start_of_turn>model"
GEMMA_EOT = "<end_of_turn>"

LLAMA_USER = "<s>[INST]"
LLAMA_EOT = "[/INST]</s>"
LLAMA_SYSTEM = (
    "<<SYS>> You are a helpful, respectful, and honest assistant. "
    "Answer the questions given the context. <</SYS>>"
)

INSTRUCTION_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Response:\n"
)
INSTRUCTION_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input that "
    "provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n"
)

# `\G` is a literal backslash followed by G in the request head
CONTEXT_REQUEST_HEAD = "Question: {question}\n\nAnswer: {answer}\n\\Generated Context: "
DATE_MARK_HEAD = "CONTEXT: {context}\n\nIDENTIFY DATES: "
JUDGE_MESSAGE = "{instruction}\n Answer 1: \n{gen1}\n Answer 2:\n{gen2}"
CONTEXT_QUESTION = "Context: {context}\n\nQuestion: {question}\n\n"

DATE_MARKER = "####"

CONTEXT_SYSTEM_PROMPT = """
You will be provided with a question and an answer. Let's play a game where you pretend that all of the answers are correct. Your job is to output a *Generated Context* section. In this section, generate some relevant context that would help answer the question. The context should be in the same style and format as a wikipedia article.

Question: What Movie won seven Oscars in 1994?

Answer: Schindler's List

Generated Context: Schindler's List premiered on November 30, 1993, in Washington, D.C., and was released on December 15, 1993, in the United States. Often listed among the greatest films ever made, the film received widespread critical acclaim for its tone, acting (particularly Neeson, Fiennes, and Kingsley), atmosphere, score, cinematography, and Spielberg's direction; it was also a box office success, earning $322.2 million worldwide on a $22 million budget. It was nominated for twelve awards at the 66th Academy Awards, and won seven, including Best Picture, Best Director (for Spielberg), Best Adapted Screenplay, and Best Original Score. The film won numerous other awards, including seven BAFTAs and three Golden Globe Awards. In 2007, the American Film Institute ranked Schindler's List 8th on its list of the 100 best American films of all time. The film was designated as "culturally, historically or aesthetically significant" by the Library of Congress in 2004 and selected for preservation in the United States National Film Registry.


"""

DATE_MARK_SYSTEM_PROMPT = """
You will be provided with a CONTEXT. Your job is to return the context word for word but also identify dates by surrounding them with the tokens "####" on either side. Below is an example 

CONTEXT: Schindler's List premiered on November 30, 1993, in Washington, D.C., and was released on December 15, 1993, in the United States. Often listed among the greatest films ever made, the film received widespread critical acclaim for its tone, acting (particularly Neeson, Fiennes, and Kingsley), atmosphere, score, cinematography, and Spielberg's direction; it was also a box office success, earning $322.2 million worldwide on a $22 million budget. It was nominated for twelve awards at the 66th Academy Awards, and won seven, including Best Picture, Best Director (for Spielberg), Best Adapted Screenplay, and Best Original Score. The film won numerous other awards, including seven BAFTAs and three Golden Globe Awards. In 2007, the American Film Institute ranked Schindler's List 8th on its list of the 100 best American films of all time. The film was designated as "culturally, historically or aesthetically significant" by the Library of Congress in 2004 and selected for preservation in the United States National Film Registry.

IDENTIFY DATES: Schindler's List premiered on ####November 30, 1993####, in Washington, D.C., and was released on ####December 15, 1993####, in the United States. Often listed among the greatest films ever made, the film received widespread critical acclaim for its tone, acting (particularly Neeson, Fiennes, and Kingsley), atmosphere, score, cinematography, and Spielberg's direction; it was also a box office success, earning $322.2 million worldwide on a $22 million budget. It was nominated for twelve awards at the 66th Academy Awards, and won seven, including Best Picture, Best Director (for Spielberg), Best Adapted Screenplay, and Best Original Score. The film won numerous other awards, including seven BAFTAs and three Golden Globe Awards. In ####2007####, the American Film Institute ranked Schindler's List 8th on its list of the 100 best American films of all time. The film was designated as "culturally, historically or aesthetically significant" by the Library of Congress in ####2004#### and selected for preservation in the United States National Film Registry.



"""

JUDGE_SYSTEM_PROMPT = (
    "You will be presented with a choice of two possible responses for an instruction"
    "You have to pick the best one and give a reason why.\n"
    "The reponse should follow the instructions and use the provided context if there is some\n"
    "If both answers are equivalent, pick the value 0"
)

JUDGE_FUNCTION = {
    "name": "make_choice",
    "description": "Select the best generation and explain why",
    "parameters": {
        "type": "object",
        "properties": {
            "choice": {
                "type": "integer",
                "description": "the choosen alternative, zero if equivalent",
            },
            "argument": {
                "type": "string",
                "description": "Reason why the choice was made",
            },
        },
    },
    "required": ["choice", "argument"],
}

CHAT_MODEL = "gpt-4-1106-preview"
JUDGE_MODEL = "gpt-4"
SAMPLING = {"temperature": 0.7, "max_tokens": 1024, "top_p": 1.0}

# split: 30 % held out, held-out half is test; sklearn-style ceil sizes
HELD_FRACTION = 0.3
TEST_OF_HELD = 0.5
SPLIT_SEED = 27
HOLDOUT_LAST = 100

PACK_LEN = 1024          # sequence length; stride is PACK_LEN + 1
PAD_LEN = 512            # classifier truncation / padding length
BATCH_SIZE = 8           # first training script; the grid runner uses 4
ACCUM_TARGET = 32        # gradient accumulation = ACCUM_TARGET div batch size
EPOCHS = 3

GRID_MODELS = ["GEMMA", "Llama"]
GRID_CONTEXTS = ["no_context", "random_context", "rel_context", "WD_context"]

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------

# Our own choices.
# model name -> public model id (a lookup the caller may replace)
MODEL_PATHS = {"GEMMA": "google/gemma-2b-it", "Llama": "meta-llama/Llama-2-7b-chat-hf"}
DEFAULT_SEED = 42
VOCAB_SIZE = 32000       # hashed word-id space (ids 0..VOCAB_SIZE-1)
PAD_ID = 0
BOS_ID = 1
EOS_ID = 2
FIRST_WORD_ID = 3

FAMILIES = ["gemma", "llama"]
CONTEXT_KINDS = ["no_context", "relevant_context", "wrong_date_context", "random_context"]
