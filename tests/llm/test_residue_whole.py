import pytest

from weftline.llm.residue import slots


@pytest.mark.parametrize(
    "unit",
    [
        "[Add two or three sentences about the product here]", "We are a firm. [Insert a short paragraph of at least three sentences that tells visitors what the company makes]", "<Add two or three sentences about the product and its makers here>",
        "(a paragraph of two or three sentences about the product and its makers goes here)", "{{company_name}} prints labels for wineries.", "${city} is where we write firmware for pumps.", "[Company Name] sells spreadsheets to farms.",
        "We make three types of pumps in {{city}}.", "We print labels for {{company_name}}.", "{{company_name}} sells templates to notaries.",
    ],
)
def test_long_instructions_and_marks_beside_product_words_are_slots(unit):
    assert slots(unit)


@pytest.mark.parametrize(
    "unit",
    [
        "Templates use ${amount} for totals, and Yotelbase checks that each field has a value.", "Felder wie {{Vorname}} füllt Tegalio beim Versand der Rechnungen.", "The printer driver fills [Name] and [Address] marks on every label from the sheet.",
        "El campo [Nombre] se completa al imprimir cada etiqueta.", "Writers type {{first_name}} in a subject line before the mail goes out.", "It stores them as pairs [see the notes of the third part for what that means in practice] for later.",
    ],
)
def test_texts_about_marks_stay_texts(unit):
    assert not slots(unit)
